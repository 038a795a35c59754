import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from vibralake.llm import quality


def keys(text):
    return quality.grams(pa.array([text]))[0].tolist()


class Brute:
    """Interpolated modified Kneser-Ney by its definition."""

    def __init__(self, texts):
        self.counts = {quality.ORDER: Counter(k for t in texts for k in keys(t))}
        for k in range(quality.ORDER - 1, 0, -1):
            self.counts[k] = Counter(g & quality._low(k) for g in self.counts[k + 1])
        self.cut = {k: quality.discounts([sum(v == i for v in c.values()) for i in range(1, 5)]) for k, c in self.counts.items()}
        self.context = {k: defaultdict(list) for k in self.counts}
        for k, c in self.counts.items():
            for g, n in c.items():
                self.context[k][g >> quality.BITS].append(n)

    def p(self, gram, k=quality.ORDER):
        if k == 0:
            return 1 / (1 << quality.BITS)
        of = lambda n: self.cut[k][min(n, 3) - 1]
        lower = self.p(gram & quality._low(k - 1), k - 1)
        seen = self.context[k].get(gram >> quality.BITS)
        if not seen:
            return lower
        n = self.counts[k].get(gram, 0)
        return (max(n - of(n), 0) if n else 0) / sum(seen) + sum(map(of, seen)) / sum(seen) * lower


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    good = [" ".join(rng.choice(["there", "where", "here", "the", "these", "other"]) for _ in range(rng.randrange(3, 40))) for _ in range(300)]
    bad = ["".join(rng.choice("#$%QXZ!&") for _ in range(80)) for _ in range(20)]
    return good, bad


@pytest.mark.parametrize("limit", [10**6, 0])
def test_perplexities_equal_the_definition(spark, corpus, limit):
    good, bad = corpus
    model = Brute(good[:50])
    table = quality.train(spark.createDataFrame([(t,) for t in good[:50]], "text string"))
    asked = [*good[45:60], *bad[:3], "", "日本 there"]
    work = spark.createDataFrame([(i, i, t) for i, t in enumerate(asked)], "key_a bigint, key_b bigint, text string")
    wanted = work.select("text").mapInArrow(lambda b: quality._collected(b, False), "gram bigint, n bigint")
    found = {r["key_a"]: r for r in quality.perplexities(work, quality.score(wanted, table), limit).collect()}
    for i, t in enumerate(asked):
        assert found[i]["n_symbols"] == len(t.encode())
        assert math.isclose(found[i]["loss"] / quality.UNIT, -sum(math.log(model.p(k)) for k in keys(t)), rel_tol=1e-5, abs_tol=1e-6)


def test_probabilities_sum_to_one(corpus):
    model = Brute(corpus[0][:30])
    context = next(iter(model.counts[quality.ORDER])) >> quality.BITS
    assert math.isclose(sum(model.p(context << quality.BITS | s) for s in range(1 << quality.BITS)), 1, rel_tol=1e-9)


def test_good_stays_and_bad_goes(spark, corpus):
    good, bad = corpus
    rows = [(i, t, "en" if i % 2 else None, "clash") for i, t in enumerate(good + bad)] + [(None, good[0], "xx", "c"), (5000, None, "en", "c"), (5001, "", "en", "c"), (3, good[3], None, "clash")]
    labels = [(i, 1, 0, "c") for i in range(250)] + [(i, 0, 0, "c") for i in range(300, 310)] + [(None, 1, 0, "c"), (2, None, 0, "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, perplexity string")
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int, kept string")
    out = {r["doc_id"]: r for r in quality.classify(docs, table, columns=("perplexity",)).collect()}
    assert out[5000]["kept"] and out[5001]["kept"] and out[None]["kept"]
    assert sum(out[i]["kept"] for i in range(250, 300)) >= 46
    assert sum(out[i]["kept"] for i in range(250)) >= 240
    assert not any(out[i]["kept"] for i in range(300, 320))
    assert out[5000]["perplexity"] is None
    few = quality.classify(docs, table, trusted_rows=0).filter("doc_id = 300").first()
    assert not few["kept"]


def test_no_labels_and_no_rows(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    out = quality.classify(docs, none).collect()
    assert len(out) == docs.count() and all(r["kept"] and r["threshold"] is None for r in out)
    assert quality.classify(empty, none).count() == 0


def test_lookup_finds_all_keys():
    keys_ = np.unique(np.random.default_rng(1).integers(0, 1 << 60, 5000))
    table = quality.Lookup(keys_, np.arange(len(keys_), dtype=np.int32))
    assert (table.of(keys_[::-1].copy()) == np.arange(len(keys_))[::-1]).all()


def test_equal_results_over_partitionings_and_both_ways(spark, corpus):
    good, bad = corpus
    rows = [(i, t, ["en", "de", "fr"][i % 3]) for i, t in enumerate(good + bad)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(250)], "doc_id bigint, quality int, toxic int")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    results = []
    for parts, bound in ((1, 10**6), (3, 10**6), (7, 0)):
        out = quality.classify(docs.repartition(parts), labels.repartition(parts), scored_grams=bound)
        results.append(sorted(map(tuple, out.select("doc_id", "n_symbols", "perplexity", "threshold", "kept").collect())))
    assert results[0] == results[1] == results[2]


def test_a_row_at_its_threshold_is_kept_and_one_above_goes(spark):
    """Calibration rows that are all alike: each is at the threshold itself."""
    docs = spark.createDataFrame([(i, "the same words again and again", "en") for i in range(400)] + [(500, "zq" * 300, "en")], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(400)], "doc_id bigint, quality int, toxic int")
    out = {r["doc_id"]: r for r in quality.classify(docs, labels).collect()}
    assert all(out[i]["kept"] and math.isclose(out[i]["perplexity"], out[i]["threshold"], rel_tol=1e-4) for i in range(400)) and not out[500]["kept"]


def test_scripts_do_not_share_symbols_and_rare_languages(spark, corpus):
    """Han, Hangul and Thai texts of few trusted rows are kept, and noise of their own script goes; a language without trusted rows is kept."""
    rng = random.Random(9)
    words = {"zh": ["的是在不了", "有和人这中", "大为上个国"], "ko": ["하고있는", "그리고나는", "사람들이"], "th": ["ที่เป็น", "และการ", "ของเรา"]}
    rows, labels = [], []
    for k, (lang, some) in enumerate(words.items()):
        for i in range(60):
            rows.append((k * 1000 + i, "".join(rng.choice(some) for _ in range(40)), lang))
            if i < 40:
                labels.append((k * 1000 + i, 1, 0))
        base = ord(some[0][0])
        rows += [(k * 1000 + 500 + i, "".join(chr(base + rng.randrange(-40, 40)) for _ in range(200)), lang) for i in range(5)]
    rows += [(9000, "".join(words["zh"]) * 5, "xx"), *[(10_000 + i, t, "en") for i, t in enumerate(corpus[0])]]
    labels += [(10_000 + i, 1, 0) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    out = {r["doc_id"]: r for r in quality.classify(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()}
    assert out[9000]["kept"] and out[9000]["threshold"] is None
    for k in range(3):
        assert all(out[k * 1000 + i]["kept"] for i in range(60)) and not any(out[k * 1000 + 500 + i]["kept"] for i in range(5))
    codes, sizes = quality.grams(pa.array(["的", "鄿", "A", "中"]))
    assert sizes.tolist() == [3, 3, 1, 3] and len(set(codes[[2, 5, 6, 9]].tolist())) == 4


def test_a_very_long_text(spark, corpus):
    long = " ".join(corpus[0]) * 60  # over a megabyte, alone in its piece
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(corpus[0])] + [(900, long, "en")], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(250)], "doc_id bigint, quality int, toxic int")
    row = quality.classify(docs, labels).filter("doc_id = 900").first()
    assert len(long) > 1 << 20 and row["n_symbols"] == len(long) and row["kept"]
