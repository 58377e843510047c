"""Every query on empty tables, on nulls only, and on repeated rows."""

import pytest

from millrace.llm import registry

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
}


@pytest.fixture(scope="module")
def folders(spark, sf_of):
    def table(rows):
        return {n: spark.createDataFrame([tuple(r[: len(s.split(","))]) for r in rows(len(s.split(",")))], s) for n, s in SCHEMAS.items()}

    twice = {
        "documents": [(1, "a b c " * 40, "en", "s", 240)] * 2 + [(2, None, None, None, None)],
        "pages": [(1, "u", "<p>x</p>")] * 2 + [(2, None, None)],
        "benchmark": [(1, "a b c")] * 2,
        "labels": [(1, 1, 1)] * 2 + [(2, None, None)],
    }
    return {
        "empty": sf_of(**table(lambda n: [])),
        "nulls": sf_of(**table(lambda n: [(None,) * n] * 3)),
        "twice": sf_of(**{n: spark.createDataFrame(twice[n], s) for n, s in SCHEMAS.items()}),
    }


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_defined_results(spark, folders, name):
    query, rows = registry.queries()[name], {"empty": 0, "nulls": 3, "twice": 3}
    for kind, folder in folders.items():
        out = query(spark, folder).collect()
        assert len(out) == (0 if name.startswith("op3_") else rows[kind]), kind


def test_pipeline_on_empty_tables(spark, folders):
    import corpus_pipeline

    for kind in ("empty", "nulls", "twice"):
        assert corpus_pipeline.run(spark, folders[kind]).count() == 0  # nothing there has fifty words that don't repeat
