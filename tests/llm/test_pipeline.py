"""The pipeline against the same stages in plain Python, on a small corpus."""

import random

import pytest

import corpus_pipeline
from loadlens.llm.catalog import ORACLES, QUERIES
from tests.llm.test_decontaminate import expected as contamination
from tests.llm.test_exact_dedup import LOWER
from tests.llm.test_simhash import plain_components, plain_fingerprint

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    words = ["w%d" % i for i in range(3000)]

    def text(k=60):
        return " ".join(rng.choices(words, k=k))

    texts = [text(rng.randint(30, 200)) for _ in range(200)]
    item = text(20)
    texts += [texts[0], texts[0].upper(), texts[1] + " end", "", None, "  "]
    texts += [f"{text()} {item} {text()}", item.title()]
    toxic = [f"{text()} idiot {text()} clown {text()} scum" for _ in range(60)]
    rows = list(enumerate(texts + toxic))
    place = tmp_path_factory.mktemp("tables")
    docs = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    labels = [(i, 1, int(i >= len(texts))) for i, _ in rows]
    for name, data, schema in (
        ("documents", docs, COLUMNS),
        ("labels", labels, "doc_id long, quality int, toxic int"),
        ("benchmark", [("q", item)], "item_id string, text string"),
    ):
        spark.createDataFrame(data, schema).write.parquet(f"{place}/{name}.parquet")
    return str(place), rows[: len(texts)], [("q", item)]


def test_run(spark, folder):
    place, clean, items = folder
    best = {}
    for i, t in clean:
        key = (t or "").translate(LOWER)
        best[key] = max(best.get(key, (-1, "")), (i, t or ""))
    left = sorted(best.values())
    classes = plain_components([plain_fingerprint(t) for _, t in left])
    left = [r for n, r in enumerate(left) if classes[n] == n]
    kept = {i for i, _, hit, _ in contamination(left, items) if not hit}
    found = corpus_pipeline.run(spark, place)
    assert {r.doc_id for r in found.collect()} == kept
    assert found.count() == len(kept)


def test_stages_keep_the_columns(spark, folder):
    docs = spark.createDataFrame([(1, None, None, None, None), (None, "a", "x", "y", 1)], COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        for frame in (docs, docs.limit(0)):
            found = stage(spark, frame, folder[0])
            assert found.count() == frame.count(), name
            if name != corpus_pipeline.STAGES[-1][0]:
                assert found.schema == docs.schema


def test_a_query_for_every_number():
    numbers = {int(name.split("_")[0][2:]) for name in QUERIES}
    assert numbers == set(range(1, 14)) and set(ORACLES) <= set(QUERIES)
