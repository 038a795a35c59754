"""A large group of near copies: links are found without pairs of all with all."""

import random

import pytest

from vibralake.llm import ngram_join
from test_dedup import brute_components, same


@pytest.mark.parametrize("center", [True, False])
def test_near_copies_with_and_without_a_centre(spark, monkeypatch, center):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)  # columns are cut into many blocks
    monkeypatch.setattr(ngram_join, "PRODUCT", 50)
    rng = random.Random(1)
    base = [f"b{i}" for i in range(100)]
    rows = [(0, " ".join(base))] * center
    for i in range(1, 120):
        own = list(base)
        for _ in range(rng.choice([1, 1, 2, 3, 5])):
            own[rng.randrange(100)] = f"e{rng.randrange(10**9)}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, " ".join([*base[:40], *(f"o{i}.{j}" for j in range(60))])) for i in range(30)]  # a shared passage is no link
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    same([tuple(r)[:3] for r in ngram_join.link_components(df).collect()], brute_components(rows))


def test_links_are_all_counted(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 16, raising=False)  # a group is cut into several blocks
    rng = random.Random(3)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(90):
        own = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            own[rng.randrange(100)] = f"e{rng.randrange(10**9)}"
        rows.append((i, " ".join(own)))
    rows += [(200, rows[1][1]), (201, rows[1][1].upper()), (202, "alone but not empty, and far from all others"), (203, ""), (204, None), (205, "two words"), (206, "Two words")]
    sets = [{" ".join(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if (w := (t or "").lower().split()) else set() for _, t in rows]
    wanted = {i: sum(k != j and bool(a & b) and 100 * len(a & b) >= 80 * len(a | b) for k, b in enumerate(sets)) for j, ((i, _), a) in enumerate(zip(rows, sets, strict=True))}
    out = ngram_join.link_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["n_links"] for r in out} == wanted
    assert max(wanted.values()) > 20
