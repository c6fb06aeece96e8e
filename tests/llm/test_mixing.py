import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.llm import mixing as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, weight int, topic string"
TARGETS = {"source": {"a": 2.0, "b": 1.0, "absent": 1.0}, "lang": {"en": 0.5, "de": 0.5},
           "topic": {"short": 0.7, "article": 0.2, "markup": 0.1}}


def rows(n=2000):
    rng = np.random.default_rng(6)
    out = [(None, None, None, None, 0, 1, "t"), (-1, "", "en", "a", 0, 1, "t"), (-2, "word", "xx", "zzz", 4, 1, "t"), (-2, "word", "xx", "zzz", 4, 1, "t")]
    for i in range(n):
        k = int(rng.choice([20, 250, 30], p=[0.6, 0.3, 0.1]))
        word = "w#" if k == 30 else "word"
        out.append((i, " ".join([word] * k), str(rng.choice(["en", "de"], p=[0.8, 0.2])), str(rng.choice(["a", "b", "c"], p=[0.6, 0.3, 0.1])), 0, 1, "t"))
    return out


def test_marginals_are_met(spark):
    frame = spark.createDataFrame(rows(), SCHEMA)
    out = M.mix(frame, TARGETS, budget=0.3)
    got = out.toPandas()
    assert len(got) == 2004
    fitted = (got["weight"] * got["n_tokens"]).sum()
    tokens = got["n_tokens"].sum()
    assert fitted == pytest.approx(tokens)
    other = got.loc[got["source"] == "(other)", "n_tokens"].sum() / tokens
    for name, share in (("a", 2 / 3), ("b", 1 / 3)):  # "absent" has no document
        part = got[got["source"] == name]
        assert (part["weight"] * part["n_tokens"]).sum() / fitted == pytest.approx(share * (1 - other) / (1 - 0) * 1.0, rel=0.35)
    en = got[got["lang"] == "en"]
    assert (en["weight"] * en["n_tokens"]).sum() / fitted == pytest.approx(0.5, abs=0.01)
    assert (got["probability"] * got["n_tokens"]).sum() == pytest.approx(0.3 * tokens, rel=1e-6)
    assert got["probability"].between(0, 1).all()
    assert got.loc[got["sampled"], "n_tokens"].sum() == pytest.approx(0.3 * tokens, rel=0.1)
    again = M.mix(frame.repartition(7), TARGETS, budget=0.3).where("sampled").select("doc_id").collect()
    assert sorted(map(str, again)) == sorted(map(str, [r for r in out.where("sampled").select("doc_id").collect()]))


def test_rake_equals_the_plain_method():
    rng = np.random.default_rng(2)
    table = rng.random((3, 4, 2)) * 100
    wants = [rng.random(n) for n in table.shape]
    wants = [w / w.sum() for w in wants]
    plain = table.copy()
    for _ in range(500):
        for axis, want in enumerate(wants):
            have = plain.sum(axis=tuple(a for a in range(3) if a != axis))
            plain *= np.expand_dims(want * table.sum() / have, tuple(a for a in range(3) if a != axis))
    index = np.stack([x.ravel() for x in np.indices(table.shape)], axis=1)
    assert M.rake(index, table.ravel(), wants) == pytest.approx(plain.ravel(), rel=1e-6)


def test_budget_beyond_the_corpus_keeps_all_and_empty_tables(spark):
    frame = spark.createDataFrame(rows(50), SCHEMA)
    assert M.mix(frame, TARGETS, budget=1.0).where("n_tokens > 0 and not sampled").count() == 0
    assert M.mix(frame.limit(0), TARGETS).count() == 0
    with pytest.raises(ValueError, match="too many"):
        M.mix(frame, TARGETS | {"source": {str(i): 1.0 for i in range(200_000)}})


def test_uniform_is_uniform(spark):
    u = spark.range(4000).select(M.uniform("id", "s").alias("u")).agg(F.avg("u"), F.stddev("u")).first()
    assert u[0] == pytest.approx(0.5, abs=0.02) and u[1] == pytest.approx(12**-0.5, abs=0.02)


def cells(seed, hot=1.0):
    rng = np.random.default_rng(seed)
    index = np.stack([x.ravel() for x in np.indices((4, 3, 2))], axis=1)
    tokens = rng.integers(50, 1000, len(index)).astype(float)
    tokens[index[:, 0] == 0] *= hot
    return index, tokens


@pytest.mark.parametrize("seed", range(5))
def test_targets_are_met_where_cells_are_full(seed):
    """Some cells would have probabilities beyond 1; the others make up."""
    index, tokens = cells(seed, hot=6.0)
    targets = [np.array([0.25] * 4), np.array([0.5, 0.3, 0.2]), np.array([0.6, 0.4])]
    wanted = M.wanted_shares(index, tokens, targets)
    most = M.largest_budget(index, tokens, wanted, tokens.sum()) / tokens.sum()
    for part in (0.6, 0.95):
        p, _ = M.fit(index, tokens, targets, most * part, False)
        assert p.max() <= 1 and (p * tokens).sum() == pytest.approx(most * part * tokens.sum(), rel=1e-4)
        for got, want in zip(M.reached_shares(index, p * tokens, [4, 3, 2]), wanted, strict=True):
            assert got == pytest.approx(want, abs=1e-4)
    p, _ = M.fit(index, tokens, targets, 1.0, True)
    assert (p * tokens).sum() == pytest.approx(most * tokens.sum(), rel=5e-3)
    for got, want in zip(M.reached_shares(index, p * tokens, [4, 3, 2]), wanted, strict=True):
        assert got == pytest.approx(want, abs=2 * M.MET)


def test_values_with_too_little_are_taken_whole():
    got = M.attainable(np.array([60.0, 30.0, 10.0, 0.0]), np.array([0.4, 0.3, 0.3, 0.0]), 50.0)
    assert got * 50 == pytest.approx([40 * 4 / 7, 40 * 3 / 7, 10, 0])
    index = np.array([[0, 0, 0], [1, 0, 0], [2, 0, 0]])
    p, _ = M.fit(index, np.array([60.0, 30.0, 10.0]), [np.array([0.4, 0.3, 0.3]), np.ones(1), np.ones(1)], 0.5, False)
    assert p * [60, 30, 10] == pytest.approx([40 * 4 / 7, 40 * 3 / 7, 10], abs=1e-3)


def test_rows_tell_wanted_and_reached_shares(spark):
    got = M.mix(spark.createDataFrame(rows(), SCHEMA), TARGETS, budget=0.3).toPandas()
    expected = got["probability"] * got["n_tokens"]
    for m in M.MARGINALS:
        for _, part in got.groupby(m):
            assert part[f"{m}_reached"].iloc[0] == pytest.approx(expected[part.index].sum() / expected.sum(), abs=1e-9)
    short = got[got["topic"] == "short"]
    assert short["topic_reached"].iloc[0] < short["topic_wanted"].iloc[0] and (short["probability"][short["n_tokens"] > 0] > 0.99).all()


def test_registered_query_equals_plain_python(spark):
    """Tokens, topics, cells, expected tokens, shares and the sampled rows of
    op7, recomputed text by text."""
    import hashlib
    import re
    from collections import defaultdict

    from encore.llm.queries import MIX_TARGETS, op7_mixing, table

    from .test_queries import SMALL

    docs = {r["doc_id"]: r for r in table(spark, SMALL, "documents").collect()}
    got = {r["doc_id"]: r for r in op7_mixing(spark, SMALL).collect()}
    assert got.keys() == docs.keys()
    cell_tokens, value_tokens, p_of = defaultdict(int), defaultdict(float), {}
    for i, d in docs.items():
        text, r = d["text"] or "", got[i]
        n = max(len(text), 1)
        share = lambda rx: len(re.findall(rx, text)) / n  # noqa: E731, B023
        topic = ("markup" if share(r"[#*$%&|<>]") > 0.05 else "capitals" if share("[A-Z]") > 0.3 else "figures" if share("[0-9]") > 0.05
                 else "short" if len(text) < 1000 else "article" if len(text) < 5000 else "long")
        tokens = len(re.findall(r"[^\x20\x09-\x0D]+", text))
        cell = (d["source"] if d["source"] in MIX_TARGETS["source"] else M.OTHER, d["lang"] if d["lang"] in MIX_TARGETS["lang"] else M.OTHER, topic)
        assert (r["source"], r["lang"], r["topic"], r["n_tokens"]) == (*cell, tokens)
        assert p_of.setdefault(cell, r["probability"]) == r["probability"]
        cell_tokens[cell] += tokens
        drawn = int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:12], 16) / (1 << 48)
        assert r["sampled"] == (drawn < r["probability"])
    total, expected = sum(cell_tokens.values()), sum(cell_tokens[c] * p for c, p in p_of.items())
    assert expected == pytest.approx(0.5 * total, rel=1e-3) and all(0 <= p <= 1 for p in p_of.values())
    for cell, p in p_of.items():
        for k in range(3):
            value_tokens[k, cell[k]] += cell_tokens[cell] * p / expected
    for r in got.values():
        for k, m in enumerate(M.MARGINALS):
            assert r[f"{m}_reached"] == pytest.approx(value_tokens[k, r[m]], abs=1e-9)
