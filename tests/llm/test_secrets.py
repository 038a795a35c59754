import hashlib
import random
import re
import time

from vibralake.llm import secrets

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def brute(text):
    text = text or ""
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    more = []
    for kind, (letters, _, fold, bits) in secrets.CLASSES.items():
        for m in re.finditer(f"{letters}{{{secrets.WINDOW},}}", text):
            if re.search(secrets.ALLOW, m[0]):
                continue
            s = m[0].lower() if fold else m[0]
            open_ = None
            for i in range(len(s) - secrets.WINDOW + 1):
                part = s[i : i + secrets.WINDOW]
                if sum(secrets.weight(part.count(c)) for c in set(part)) > secrets.bound(secrets.WINDOW, bits):
                    continue
                if open_ and i < open_[1]:
                    open_[1] = i + secrets.WINDOW
                else:
                    if open_:
                        more.append((m.start() + open_[0], secrets.KINDS.index(kind), m.start() + open_[1]))
                    open_ = [i, i + secrets.WINDOW]
            if open_:
                more.append((m.start() + open_[0], secrets.KINDS.index(kind), m.start() + open_[1]))
    text_of = lambda x: ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(x))
    return *[sum(k == i for _, k, _ in base) for i in range(3)], hashlib.sha256(text_of(base).encode()).hexdigest(), text_of(base + more)


def test_equals_brute_force(docs, rows):
    found = sorted(map(tuple, secrets.digest(docs).collect()), key=str)
    assert found == sorted(((r[0], *brute(r[1])) for r in rows), key=str)
    assert any("entropy_base64" in r[5] for r in found) and any("assign" in r[5] for r in found)


def test_short_value_hides_what_it_covers(spark):
    df = spark.createDataFrame([(1, "secret: token: abcdefgh")], "doc_id bigint, text string")
    assert secrets.digest(df).first()["n_assign"] == 0


def test_allow_list_and_letters(spark):
    rows = ["zQ3kP9xQ7mR2vT8yB5nC1wD4-example", "Donaudampfschifffahrtsgesellschaftskapitaen", "123456789012345678901234567890"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id bigint, text string")
    assert not any("entropy" in r["spans"] for r in secrets.digest(df).collect())


def test_keeps_other_columns_and_empty_tables(docs, empty):
    out = secrets.scan_secrets(docs.withColumnRenamed("source", "base_spans"))
    assert {"key_a", "rank", "row", "all_spans"} <= set(out.columns) and out.count() == docs.count()
    assert secrets.digest(empty).count() == 0


def test_no_python_on_the_path(docs):
    plan = secrets.digest(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_blocks_of_long_candidates(spark):
    """Hot and cold stretches that end anywhere in the blocks of windows, against the definition."""
    rng = random.Random(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    stretch = lambda: "".join(rng.choice(letters) for _ in range(rng.randrange(5, 90))) + rng.choice("abc") * rng.randrange(1, 70)
    rows = [" ".join("".join(stretch() for _ in range(rng.randrange(1, 25))) for _ in range(4)) for _ in range(12)]
    rows += ["x" + "".join(rng.choice("0123456789abcdef") for _ in range(n)) for n in (23, 24, 25, 255, 256, 257, 278, 279, 280, 281, 2000)]
    out = secrets.digest(spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")).collect()
    assert sorted(map(tuple, out)) == sorted((i, *brute(t)) for i, t in enumerate(rows))


def test_very_long_texts_take_time_in_proportion(spark):
    def run(n):
        text = "é token=abcdef " * n
        start = time.perf_counter()
        out = secrets.digest(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
        assert out["n_assign"] == n
        if n < 100_000:
            assert tuple(out) == (1, *brute(text))
        return time.perf_counter() - start

    run(100)
    one, ten = run(80_000), run(800_000)  # 1 MB and 10 MB
    assert ten < 20 * one + 10
