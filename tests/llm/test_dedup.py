import hashlib
import random
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vibralake.llm import exact_dedup, line_dedup, ngram_join, shared, substring

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
low = lambda d: (d is not None, d or 0)  # noqa: E731  nulls come last when the largest stays


def same(found, wanted):
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, wanted), key=str)


def test_exact(docs, rows, empty):
    groups = defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(FOLD)].append(r[0])
    found = [tuple(r) for r in exact_dedup.digest(docs).collect()]
    same([(r[0], r[1], r[2], r[4]) for r in found], [(d, max(g, key=low), len(g), sha(t)) for t, g in groups.items() for d in g])
    assert sum(r[3] for r in found) == len(groups)
    assert all(r[0] == r[1] for r in found if r[3])
    smallest = exact_dedup.exact_groups(docs).collect()
    same([(r[0], r[1]) for r in smallest], [(d, min(g, key=lambda x: (x is None, x or 0))) for g in groups.values() for d in g])
    assert exact_dedup.digest(empty).count() == 0


@given(st.lists(st.binary(max_size=12)), st.integers(0, 5))
@settings(max_examples=200, deadline=None)
def test_trie_maps_and_keeps_subtrees(keys, n):
    trie = exact_dedup.Trie()
    for i, key in enumerate(keys):
        node = trie.at(key)
        node.data = [*(node.data or []), i]
    wanted = defaultdict(list)
    for i, key in enumerate(keys):
        wanted[key].append(i)
    keep = keys[0][:n] if keys else b""
    gone = dict(trie.take(keep))
    assert gone == {k: v for k, v in wanted.items() if not k.startswith(keep)}
    assert dict(trie.take()) == {k: v for k, v in wanted.items() if k.startswith(keep)}


def test_small_budget_gives_out_subtrees(spark, rows, docs, monkeypatch):
    from functools import partial

    monkeypatch.setattr(exact_dedup, "_local", partial(exact_dedup._local, budget=2000))
    monkeypatch.setattr(exact_dedup, "_owners", partial(exact_dedup._owners, budget=500))
    assert sum(r["kept"] for r in exact_dedup.digest(docs).collect()) == len({(r[1] or "").translate(FOLD) for r in rows})


def brute_lines(rows, least=40, times=5):
    holders = defaultdict(set)
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(FOLD)
    for r in rows:
        for x in (r[1] or "").split("\n"):
            if len(key(x)) >= least:
                holders[key(x)].add(r[0])
    gone = {k: max(h, key=low) for k, h in holders.items() if len(h) >= times}
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if key(x) not in gone or gone[key(x)] == r[0]]
        yield r[0], len(lines), len(lines) - len(kept), sha("\n".join(kept))


@pytest.mark.parametrize("limits", [{}, {"filter_bytes": 0, "confirmed_keys": 0}])
def test_lines(docs, rows, empty, limits):
    out = line_dedup.dedup_lines(docs, keep="largest", columns=("lang", "key_a", "rank"), **limits)
    assert out.columns == ["doc_id", "lang", "key_a", "rank", "text", "n_lines", "n_dropped"]
    same([(r["doc_id"], r["n_lines"], r["n_dropped"], sha(r["text"])) for r in out.collect()], brute_lines(rows))
    assert line_dedup.digest(empty).count() == 0


def test_lines_count_code_points(spark):
    rows = [(i, t) for t in ("é" * 39, "é" * 40) for i in range(6)]
    df = spark.createDataFrame([(i + 10 * (len(t) - 39), t) for i, t in rows], "doc_id bigint, text string")
    assert sorted(r["n_dropped"] for r in line_dedup.digest(df).collect()) == [0] * 7 + [1] * 5


def brute_windows(rows, n=35):
    split = [WORD.findall(r[1] or "") for r in rows]
    count = defaultdict(int)
    for w in split:
        for i in range(len(w) - n + 1):
            count[tuple(w[i : i + n])] += 1
    for r, w in zip(rows, split, strict=True):
        gone = {j for i in range(len(w) - n + 1) if count[tuple(w[i : i + n])] > 1 for j in range(i, i + n)}
        yield r[0], len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_windows(docs, rows, empty, limit):
    out = substring.dedup_substrings(docs, filter_bytes=limit)
    same([(r["doc_id"], r["n_words"], r["n_removed"], sha(r["text"])) for r in out.collect()], brute_windows(rows))
    if limit:
        assert substring.digest(empty).count() == 0


def test_hot_anchors_are_dealt_out(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(substring, "FAIR_ROWS", 2)  # nearly every repeated anchor and phrase is a hot one
    out = substring.dedup_substrings(docs)
    same([(r["doc_id"], r["n_words"], r["n_removed"], sha(r["text"])) for r in out.collect()], brute_windows(rows))


@pytest.fixture(scope="module")
def long_rows(spark):
    """Two texts of over a megabyte that share passages and lines, copies of one in other letters, and short ones."""
    rng = random.Random(21)
    lines = [" ".join(f"w{rng.randrange(3000)}" for _ in range(40)) for _ in range(6000)]
    long = "\n".join(lines)
    other = "\n".join(rng.sample(lines, 3000) + [f"line {i} with words of its own, and more of them" for i in range(3000)])
    rows = [(1, long), (2, long.upper()), (3, other), (4, None), (5, ""), *[(10 + i, "\n".join(lines[i : i + 3])) for i in range(5)], (20, "x" * 1_500_000)]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string")


def test_very_long_texts(long_rows):
    rows, df = long_rows
    same([tuple(r) for r in line_dedup.digest(df).collect()], brute_lines(rows))
    same([tuple(r) for r in substring.digest(df).collect()], brute_windows(rows))
    same([tuple(r)[:3] for r in ngram_join.digest(df).collect()], brute_components(rows))
    exact = {r["doc_id"]: r for r in exact_dedup.digest(df).collect()}
    assert exact[1]["keep_id"] == 2 and exact[1]["group_size"] == 2 and exact[4]["keep_id"] == 5 and exact[20]["text_sha256"] == sha("x" * 1_500_000)


def test_a_trie_shares_edges():
    trie = exact_dedup.Trie()
    for i in range(50):
        trie.at(b"a long beginning that all strings have, " * 5 + str(i).encode()).data = [i]
    assert trie.size < 2 * 200 + 120 * exact_dedup.NODE_BYTES  # the beginning is held once
    assert len(dict(trie.take())) == 50


def test_window_of_exactly_its_length_in_one_text(spark):
    shared = " ".join(f"s{i}" for i in range(35))
    df = spark.createDataFrame([(1, f"a {shared} b {shared} c"), (2, shared[:-1]), (3, None)], "doc_id bigint, text string")
    same([tuple(r)[:3] for r in substring.digest(df).collect()], [(1, 73, 70), (2, 35, 0), (3, 0, 0)])


def brute_components(rows):
    sets = []
    for r in rows:
        w = WORD.findall((r[1] or "").translate(FOLD))
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        least[find(i)].append(r[0])
    for i, r in enumerate(rows):
        known = [d for d in least[find(i)] if d is not None]
        yield r[0], len(sets[i]), min(known) if known else None


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_components(docs, rows, empty, limit):
    out = ngram_join.link_components(docs, filter_bytes=limit).collect()
    same([tuple(r)[:3] for r in out], brute_components(rows))
    assert all((r["n_links"] > 0) == (sum(x["component_id"] == r["component_id"] for x in out) > 1) for r in out if r["doc_id"] is not None and r["n_shingles"] > 5 and r["doc_id"] not in (36, 42))
    if limit:
        assert ngram_join.digest(empty).count() == 0


def test_filters_beyond_their_bound_drop_the_same_columns(spark, monkeypatch):
    """However little is broadcast at once, columns of one row are dropped, and no table stays that isn't read again."""
    rows = [(i, " ".join(f"w{i % 90}-{j}" for j in range(40)) + f" end{i}") for i in range(100)] + [(1000, None), (1001, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    staged, kept = ngram_join.staged, []
    monkeypatch.setattr(ngram_join, "staged", lambda df, name: kept.append((name, (out := staged(df, name)).count())) or out)
    made = []
    for limit in (1 << 20, 0):
        kept.clear()
        shared.drop_staged(spark)
        out = ngram_join.link_components(docs, filter_bytes=limit, links=False)
        same([tuple(r) for r in out.collect()], brute_components(rows))
        made.append((sum(n for name, n in kept if name == "entries"), len(spark.sparkContext._vibralake_staged)))
    every = next(n for name, n in kept if name == "prefixes")
    assert made[0] == made[1] and made[1][0] < 0.4 * every and made[1][1] <= 8
