"""The pipeline's stages against brute-force versions, each on its own input."""

import re
from collections import defaultdict

import pytest

import corpus_pipeline as cp
from terracat.llm import decontaminate, toxicity

from .test_decontaminate import brute as contaminated
from .test_ngram_join import brute as groups
from .test_spans import SECRETS, spans_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, small_docs):
    docs, out = small_docs, []
    for name, stage in cp.STAGES:
        rows = stage(spark, docs, SF)
        out.append((name, docs, rows.persist()))
        docs = out[-1][2]
    yield {name: (before, after) for name, before, after in out}
    for _, _, df in out:
        df.unpersist()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES[:-1]])
def test_filters_keep_whole_rows(stages, name):
    before, after = stages[name]
    assert after.columns == before.columns and after.schema.simpleString() == before.schema.simpleString()
    left = rows(before)
    for r in rows(after):
        left.remove(r)


def test_toxicity(spark, stages):
    before, after = stages["toxicity"]
    model = toxicity.train(before, spark.read.parquet(f"{SF}/labels.parquet"))
    bad = toxicity.digest(toxicity.score(before, model)).where("predicted = 1").count()
    assert before.count() - after.count() == bad > 0


def test_near_duplicates(stages):
    before, after = stages["ngram_join"]
    docs = [(r.doc_id, r.text) for r in before.collect()]
    component = groups(docs, cp.SHINGLE_WORDS, cp.PERCENT)
    assert sorted(r.doc_id for r in after.collect() if r.doc_id is not None) == sorted(set(component.values()))
    assert sum(r.doc_id is None for r in after.collect()) == sum(i is None for i, _ in docs)


def test_near_duplicates_without_ids_of_their_own(spark):
    text = lambda name, n=60, cut=0: " ".join(f"{name}{i}" for i in range(cut, n))
    docs = [(7, text("a")), (7, text("b")), (7, text("b")), (9, text("a", cut=1)), (11, text("b", cut=1)),
            (None, text("c")), (None, text("c", cut=1)), (None, text("d")), (3, text("d")),
            (5, text("e")), (5, text("f")), (5, None), (5, ""), (6, "")] + [(8, text(f"g{i}x")) for i in range(20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = cp.drop_near_duplicates(spark, frame, SF)
    assert got.columns == ["doc_id", "text"]
    found = rows(got.where("text != ''"))
    ids = defaultdict(list)
    for i, t in found:
        ids[t.split()[-1].rstrip("0123456789")].append(i)
    assert {k: v for k, v in ids.items() if k[0] != "g"} == {"a": [7], "b": [7], "c": [None], "d": [3], "e": [5], "f": [5]}
    assert sorted(t for i, t in found if i == 8) == sorted(t for i, t in docs if i == 8)
    assert sorted(r.doc_id for r in got.where("coalesce(text, '') = ''").collect()) == [5, 6]


def test_contamination(spark, stages):
    before, after = stages["decontaminate"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    docs = list(enumerate(sorted((r.text or "" for r in before.collect()))))
    bad = {i for i, _ in contaminated(docs, items)}
    assert sorted(r.text or "" for r in after.collect()) == [t for i, t in docs if i not in bad]
    assert bad and decontaminate.overlaps(after, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0


def test_secrets(stages):
    before, after = stages["secrets"]
    clean = lambda t: not spans_of(t, SECRETS, "start")[1] and not re.search(
        r"(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}", t or "")
    assert {r.text for r in before.collect() if clean(r.text)} <= {r.text for r in after.collect()}
    assert not any(spans_of(r.text, SECRETS, "start")[1] for r in after.collect())


def test_mix(stages):
    before, after = stages["mix"]
    assert sorted(str(r.doc_id) for r in after.collect()) == sorted(str(r.doc_id) for r in before.collect())
    size, target, taken = defaultdict(int), {}, defaultdict(int)
    for r in after.collect():
        assert 0 <= r.taken <= 2 * r.size
        size[r.source] += r.size
        target[r.source] = r.target
        taken[r.source] += r.taken
    for s in size:
        assert abs(taken[s] - target[s]) < 1 and target[s] <= 2 * size[s] + 1e-6
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()), rel=1e-6)


def test_run(spark):
    assert cp.run(spark, SF).count() > 50
