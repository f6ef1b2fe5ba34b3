"""The pipeline: each stage's decisions against brute force on the stage's own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gustline.llm.language import identify_language
from tests.llm.conftest import SF_DIR
from tests.llm.test_decontamination import brute as brute_contaminated
from tests.llm.test_jaccard_join import brute as brute_groups
from tests.llm.test_packing import check_places


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before each stage and after the last."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    # Rows that a stage must get rid of, or keep.
    extra = [(9001, None), (9002, "12 34 !!"), (9003, ""), (9004, "A short but clean text.")]
    extra = [(i, t, "en", "own", 0) for i, t in extra]
    # A wrong label, and none.
    french = docs.where("lang = 'fr' AND n_chars > 2000").orderBy("doc_id").limit(2).collect()
    words = [" ".join(reversed(r.text.split())) for r in french]
    extra += [(9005, words[0], "de", "own", 0), (9006, words[1], None, "own", 0)]
    extra = spark.createDataFrame(extra, docs.schema)
    docs = docs.union(extra)
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], SF_DIR).write.parquet(f"{folder}/{k}")
        out.append(spark.read.parquet(f"{folder}/{k}"))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_all_but_the_last_keep_the_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_language_keeps_what_has_letters(stages):
    before, after = texts(stages[0]), texts(stages[1])
    lettered = {i: t for i, t in before.items() if any(c.isalpha() for c in t or "")}
    gone = lettered.keys() - after.keys()
    assert after == {i: t for i, t in lettered.items() if i not in gone}
    # Of the others, those go whose label the prediction surely contradicts.
    found = identify_language(stages[0], labelled=stages[0], keep=[F.col("lang").alias("label")]).collect()
    assert gone == {r.doc_id for r in found if r.doc_id in lettered and r.label not in (None, r.lang_pred) and r.score >= 0.25}
    assert 9005 in gone and 9006 in after and len(gone) < 0.005 * len(lettered)
    assert {r.lang for r in stages[1].where("doc_id = 9006").collect()} == {"fr"}


def test_lines_only_shorten_texts(stages):
    before, after = texts(stages[1]), texts(stages[2])
    assert before.keys() == after.keys()
    shorter = [i for i in before if before[i] != after[i]]
    assert shorter and all(len(after[i]) < len(before[i]) for i in shorter)
    assert after[9004] == before[9004]


def test_one_of_each_group_stays(stages):
    before, after = texts(stages[2]), texts(stages[3])
    groups = brute_groups(sorted(before.items()))
    assert after == {i: before[i] for i, n, component in groups if not n or i == component}
    assert len(after) < len(before)


def test_contaminated_documents_go(spark, stages):
    before, after = texts(stages[3]), texts(stages[4])
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    from gustline.llm.decontamination import decontaminate

    gone = before.keys() - after.keys()
    flagged = decontaminate(stages[3], spark.read.parquet(f"{SF_DIR}/benchmark.parquet")).where("contaminated")
    assert gone == {r.doc_id for r in flagged.collect()} and all(after[i] == before[i] for i in after)
    some = sorted(gone)[:3] + sorted(after)[:15]
    assert [r[-1] for r in brute_contaminated([(i, before[i]) for i in some], items, 10)] == [i in gone for i in some]


def test_every_document_is_packed(stages):
    rows = stages[5].collect()
    assert {r.doc_id for r in rows} == set(texts(stages[4]))
    check_places(rows, 4096)


def test_run_over_odd_and_empty_tables(spark, odd, empty, tmp_path):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = odd.select(columns).union(odd.where("doc_id = 9").select(columns))
    for k, df in enumerate((docs, empty)):
        df.write.parquet(f"{tmp_path}/{k}/documents.parquet")
        items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
        items.write.parquet(f"{tmp_path}/{k}/benchmark.parquet")
        result = corpus_pipeline.run(spark, f"{tmp_path}/{k}")
        kept = {r.doc_id for r in result.select(F.col("doc_id")).distinct().collect()}
        assert kept >= {4, 5, 8, 9} if not k else not kept
        assert not kept & {0, 1, 2, 3, 7}


def test_ids_used_again_for_other_texts(spark):
    """A document goes by its own set, not by what another row of its id holds."""
    t, u = "one two three four five six seven", "other words that nothing else has at all"
    near = "x " * 30
    rows = [(0, t), (1, t), (1, u), (2, u.upper()), (3, None), (3, None), (None, t), (4, near), (4, near + "y"), (5, "z"), (5, "z")]
    docs = spark.createDataFrame([(i, text, "en", "s", 0) for i, text in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    expected = [(0, t), (1, u), (3, None), (3, None), (None, t), (5, "z")]
    rest = [row for row in found if row[0] == 4]
    assert sorted(expected, key=repr) == [row for row in found if row[0] != 4]
    alike = len(set(zip(near.split(), near.split()[1:]))) == 1
    assert len(rest) == (2 if alike else 1)
