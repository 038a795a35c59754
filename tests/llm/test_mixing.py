import random

import numpy as np
import pytest

from vibralake.llm import mixing


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    kinds = {"good": [f"g{i}" for i in range(200)], "poor": [f"p{i}!!" for i in range(50)], "toxic": [f"g{i}" for i in range(200)] + ["vile"] * 40}
    rows, labels = [], []
    for i in range(600):
        kind = ["good", "good", "good", "poor", "toxic"][i % 5]
        lang = ["en", "de"][i % 3 == 0]
        rows.append((i, " ".join(lang[0] + rng.choice(kinds[kind]) for _ in range(rng.randrange(20, 60))), lang, "clash", "c"))
        if i % 2:
            labels.append((i, int(kind != "poor"), int(kind == "toxic")))
    rows += [(900, None, None, "x", "y"), (901, "", "en", "x", "y"), (None, "eg1 eg2", "en", "x", "y"), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, rate string, posterior string")
    return docs, spark.createDataFrame([*labels, (None, 1, 1), (1, 1, 0)], "doc_id bigint, quality int, toxic int")


def test_held_out_domains_and_totals(corpus):
    docs, labels = corpus
    out = mixing.mix(docs, labels, columns=("rate", "source") if "source" in docs.columns else ("posterior",)).collect()
    assert len(out) == docs.count()
    known = [r for r in out if r["doc_id"] is not None and r["doc_id"] < 600]
    kind = lambda i: ["good", "good", "good", "poor", "toxic"][i % 5]
    assert np.mean([r["domain"].endswith(kind(r["doc_id"])) for r in known if r["doc_id"] % 2 == 0]) > 0.95
    assert np.mean([r["rate"] < 0.2 for r in known if kind(r["doc_id"]) != "good"]) > 0.9
    total = lambda lang: sum(r["n_tokens"] * r["rate"] for r in known if r["domain"] == f"{lang}/good")
    plain = lambda lang: sum(r["n_tokens"] for r in known if r["domain"] == f"{lang}/good")
    wanted = (plain("en") / plain("de")) ** 0.7
    assert abs(total("en") / total("de") / wanted - 1) < 0.05


def test_fit_equals_a_plain_solver(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet(np.ones(4) * 0.3, 300)
    n = rng.integers(1, 50, 300)
    members = spark.createDataFrame([(int(a), bytearray(b)) for a, b in zip(n, mixing.packed_posteriors(p), strict=True)], "tokens bigint, posterior binary")
    targets = np.array([0.4, 0.3, 0.2, 0.1])
    gaps, steps, size, shares = mixing.fit_rates(members, n @ p / n.sum(), targets, float(n.sum()), most_steps=400, tolerance=0, ridge=1e-2)
    rate = mixing.replayed(p, gaps, steps, size, 1e-2, mixing.Bounds())[0]
    plain = np.ones(300)
    for _ in range(20_000):
        gap = (n * plain) @ p / n.sum() - targets
        plain = np.maximum(plain - 0.9 * (p @ gap + 1e-2 * (plain - 1)), 0)
    assert np.abs(rate - plain).max() < 1e-4
    assert np.allclose(shares, (n * rate) @ p / n.sum())


def test_bounds_and_edges(corpus, spark, empty):
    docs, labels = corpus
    least = mixing.mix(docs, labels, least_rate=1.0, labelled_rows=0)
    assert least.filter("rate < 1").count() == 0
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    out = mixing.mix(docs, none).collect()
    assert all(r["rate"] == 1 and r["domain"] is None for r in out)
    assert {r["doc_id"]: r["n_tokens"] for r in out}[None] == 2
    assert mixing.mix(empty, none).count() == 0 and mixing.mix(docs.limit(0), labels).count() == 0


def test_a_small_domain_is_treated_like_a_large_one(spark):
    posterior = np.eye(3)
    tokens = [(900_000, 0), (100_000, 1), (20, 2)]  # good, and two poor domains of which one is 2e-5 of the corpus
    members = spark.createDataFrame([(n, bytearray(mixing.packed_posteriors(posterior)[k])) for n, k in tokens], "tokens bigint, posterior binary")
    total = float(sum(n for n, _ in tokens))
    shares = np.array([n for n, _ in tokens]) / total
    targets = np.array([shares[0], 0.0, 0.0])
    gaps, steps, size, reached = mixing.fit_rates(members, shares, targets, total, scale=np.maximum(shares, targets))
    assert mixing.replayed(posterior, gaps, steps, size, mixing.RIDGE, mixing.Bounds())[0].round(2).tolist() == [1.0, 0.0, 0.0]
    assert np.abs(reached - targets).max() < 0.01 * shares[1]


def test_rare_toxic_documents_go_and_shares_are_reported(spark):
    rng = random.Random(8)
    text = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    clean, vile = [f"c{i}" for i in range(300)], [f"v{i}" for i in range(40)]
    rows = [(i, text(clean, 4000), "en") for i in range(100)] + [(1000 + i, text(vile, 8), "en") for i in range(3)]  # 6e-5 of the words
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)] + [(1000, 0, 1), (1001, 0, 1)], "doc_id bigint, quality int, toxic int")
    report: dict = {}
    rates = {r["doc_id"]: r["rate"] for r in mixing.mix(docs, labels, power=1.0, report=report).collect()}
    assert all((round(v) > 0) == (k < 1000) for k, v in rates.items()), {k: v for k, v in rates.items() if k >= 1000}
    held = {r["doc_id"]: r["rate"] for r in mixing.mix(docs, labels, aim=lambda s: mixing.raised(s, 0.7), keep_wanted=True).collect()}
    assert all(v >= 1 if k < 1000 else v == 0 for k, v in held.items())
    assert set(report) == {"en/good", "en/toxic"}
    share, target, reached = report["en/toxic"]
    assert 0 < share < 1e-3 and target == 0 and reached < 0.1 * share


def test_many_domains_meet_their_targets_after_rounding(spark):
    """75 domains (25 languages): totals of whole uses within 1 % of the targets, where the posteriors are sure."""
    rng = random.Random(12)
    rows, labels, kinds = [], [], ("good", "good", "good", "poor", "toxic")
    for k in range(25):
        for i in range(400 if k else 1500):
            kind = kinds[i % 5]
            number = k * 10_000 + i
            rows.append((number, " ".join(f"{kind[0]}{k}x{rng.randrange(50)}" for _ in range(20)), f"l{k}"))
            if i < 30:
                labels.append((number, int(kind != "poor"), int(kind == "toxic")))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    report: dict = {}
    out = mixing.mix(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), report=report, keep_wanted=True, aim=lambda s: mixing.raised(s, 0.7))
    used = out.withColumn("uses", mixing.uses_of(out["rate"], "doc_id")).collect()
    assert len(report) == 75 and sum(target > 0 for _, target, _ in report.values()) == 25
    assert all(abs(reached - target) <= 0.01 * max(share, target) for share, target, reached in report.values())
    total = sum(r["n_tokens"] for r in used)
    assert abs(sum(r["uses"] * r["n_tokens"] for r in used) / total / sum(t for _, t, _ in report.values()) - 1) < 0.01
    for k in range(25):
        mine = [r for r in used if r["doc_id"] // 10_000 == k]
        drawn, target = sum(r["uses"] * r["n_tokens"] for r in mine) / total, report[f"l{k}/good"][1]
        assert abs(drawn / target - 1) < 0.08  # 240 documents of a language: the draw's own error
        assert all((r["uses"] >= 1) == (kinds[r["doc_id"] % 10_000 % 5] == "good") for r in mine)


def test_a_missed_target_is_warned_of(corpus):
    docs, labels = corpus
    report: dict = {}
    with pytest.warns(UserWarning, match="miss their target"):
        mixing.mix(docs, labels, targets={"en/good": 0.2, "de/good": 0.1}, least_rate=1.0, report=report)
    assert all(reached >= 0.99 * share for share, _, reached in report.values())


def test_buckets_fall_as_domains_rise():
    assert [mixing.buckets_of(k) for k in (1, 32, 33, 64, 1000, 5000)] == [1 << 16, 1 << 16, 1 << 15, 1 << 15, 1 << 11, 1 << 10]


def test_a_very_long_text(spark):
    long = "good words of all kinds " * 60_000
    docs = spark.createDataFrame([(1, long, "en"), (2, "good words", "en"), (3, "vile bad", "en")], "doc_id bigint, text string, lang string")
    out = {r["doc_id"]: r for r in mixing.mix(docs, spark.createDataFrame([(2, 1, 0), (3, 0, 1)], "doc_id bigint, quality int, toxic int")).collect()}
    assert out[1]["n_tokens"] == 300_000 and out[1]["domain"] == "en/good" and out[3]["rate"] < 0.1
