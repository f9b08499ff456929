"""The registered corpus queries: SQL where there is some, the pipeline step by step."""

import corpus_pipeline
import duckdb
import plainly
import pytest
from clicktally.llm import queries
from clicktally.llm.mixing import mixed
from compare import connect, duckdb_rows, spark_rows

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    assert spark_rows(queries.queries()[name](spark, FOLDER)) == duckdb_rows(connect(FOLDER), queries.oracle_sql()[name])


def test_mix_of_rows_without_own_numbers_against_sql(spark, tmp_path):
    """Numbers that are NULL or repeat, equal rows, texts that JSON has to quote."""
    texts = ["plain", 'quoted "words"\tand\nlines\\', "für Ölçü ☃", "", None]
    rows = [(i % 7 if i % 3 else None, texts[i % 5], [None, "de"][i % 2], ["a", "b", None][i % 4 % 3], i % 2) for i in range(400)]
    rows += [(1000 + i, "a number of its own " * 3, "en", "a", None) for i in range(50)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).coalesce(3).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    name = "op7_poisson_mix"
    found = spark_rows(queries.queries()[name](spark, str(tmp_path)))
    assert len(found[1]) > 200 and found == duckdb_rows(con, queries.oracle_sql()[name])


def test_licence_scan_is_native(spark, capsys):
    queries.queries()["op1_licence_scan"](spark, FOLDER).explain()
    plan = capsys.readouterr().out
    assert not any(node in plan for node in ("Python", "Pandas", "Arrow"))


def test_pipeline_stages_against_plain_versions(spark, documents):
    same = "a line of more than twenty code points"
    body = [" ".join(f"{chr(97 + i)}{chr(97 + k % 26)}{k}" for k in range(60)) for i in range(6)]
    rows = [(i, f"{same}\n{text}", "en", f"s{i % 2}") for i, text in enumerate(body)]
    rows += [(10, body[0] + " more", "en", "s0"), (11, None, "en", "s0"), (12, "123", None, None), (13, body[1], None, None)]
    docs = documents(rows)
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["language_id"](spark, docs, FOLDER)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {0, 1, 2, 3, 4, 5, 10, 13}

    left = stages["line_dedup"](spark, kept, FOLDER).collect()
    wanted = {i: text for i, text, *_ in plainly.without_lines([r[:2] for r in rows])}
    assert {r.doc_id: r.text for r in left} == {r.doc_id: wanted[r.doc_id] for r in left}
    assert all(r.n_chars == len(r.text) and r.component_id == "own" for r in left)

    fewer = stages["near_dedup"](spark, spark.createDataFrame(left, docs.schema), FOLDER)
    parts = plainly.near_documents([(r.doc_id, r.text) for r in left], 5, 80)
    assert {r.doc_id for r in fewer.collect()} == {i for i, top in parts.items() if i == top}
    assert fewer.columns == docs.columns

    mix = stages["source_mix"](spark, fewer, FOLDER)
    assert mix.columns == docs.columns and mix.count() == mixed(fewer).count()
    assert stages["byte_level_bpe"](spark, mix, FOLDER).count() == mix.count()


def test_pipeline_takes_languages_from_the_mixture(spark, documents):
    english, german = "the people of this town were walking", "die leute dieser stadt gingen durch felder"
    rows = [(i, text, lang, "s") for i in range(9) for text, lang in [(f"{english} {i}", "en")]]
    rows += [(20 + i, f"{german} {i}", "de", "s") for i in range(9)]
    rows += [(40, "the people were walking", None, "s"), (41, "die leute gingen durch felder", "en", "s"), (42, "12", "en", "s")]
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    found = {r.doc_id: r.lang for r in stage(spark, documents(rows), FOLDER).collect()}
    assert found[40] == "en" and found[41] == "de" and 42 not in found and len(found) == 20


def test_pipeline_leaves_one_of_copies_without_own_numbers(spark, documents):
    text = [" ".join(f"{chr(97 + i)}{k}" for k in range(40)) for i in range(4)]
    rows = [(None, text[0], "en", "s")] * 3 + [(5, text[1], "en", "s")] * 3 + [(7, text[2], "en", "s"), (None, text[2], "en", "s"), (6, text[3], "en", "s")]
    left = dict(corpus_pipeline.STAGES)["near_dedup"](spark, documents(rows), FOLDER).collect()
    assert sorted((r.text, r.doc_id) for r in left) == list(zip(text, [None, 5, 7, 6]))


def test_pipeline_without_rows_to_learn_from(spark, documents):
    rows = [(1, "clean text", None, "s"), (2, "more clean text", None, "s"), (3, "123", None, "s"), (4, None, None, "s")]
    kept = dict(corpus_pipeline.STAGES)["language_id"](spark, documents(rows), FOLDER)
    assert {(r.doc_id, r.lang) for r in kept.collect()} == {(1, None), (2, None)}


def test_pipeline_of_an_empty_table(spark, documents):
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0
        docs = docs if "text" in docs.columns else documents([])
