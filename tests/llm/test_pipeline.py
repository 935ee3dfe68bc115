import corpus_pipeline as pipeline
import pytest
from rillet.sources.tables import table

from .conftest import SF
from .test_decontam import brute as leaks
from .test_packing import brute as pieces
from .test_packing import valid
from .test_quality import brute as measures
from .test_secret_scan import brute as spans
from .test_simhash import brute_classes, brute_print


def redacted(text):
    out, end, merged = "", 0, []
    for a, _, b in spans(text):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    for a, b in merged:
        out, end = out + text[end:a] + "[SECRET]", b
    return out + text[end:]


def test_run_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    docs = [(i, t) for i, t in docs if not measures(t)[5]]  # no band rejects more here
    prints = [(i, brute_print(t)) for i, t in docs]
    classes = brute_classes(prints)
    docs = [(i, t) for (i, t), (_, fp) in zip(docs, prints) if classes[fp] == i]
    bad = {d for d, _, _ in leaks(docs, items)}
    docs = [(i, redacted(t)) for i, t in docs if i not in bad]
    rows = pipeline.run(spark, SF).collect()
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32)
                  for r in rows) == pieces(docs)
    valid(rows)


@pytest.mark.parametrize("name, stage", pipeline.STAGES[:-1])
def test_stages_keep_the_columns(spark, odd_docs, no_docs, name, stage):
    out = stage(spark, odd_docs, SF)
    assert out.schema == odd_docs.schema
    ids = [r.doc_id for r in out.collect()]
    assert set(ids) <= {r.doc_id for r in odd_docs.collect()}
    if name == "near_duplicates":
        assert ids.count(4) == 1 and sum(i in (1, 2, 3) for i in ids) == 1 and None in ids
    assert stage(spark, no_docs, SF).count() == 0


def test_last_stage(spark, odd_docs, no_docs):
    name, stage = pipeline.STAGES[-1]
    assert stage(spark, odd_docs, SF).where("piece = 0").count() == odd_docs.count()
    assert stage(spark, no_docs, SF).count() == 0


def test_equal_ids_of_different_texts(spark):
    rows = [(1, "alpha beta gamma delta"), (1, "one two three four five"), (1, "one two three four five"),
            (0, "one two three four five"), (None, "a lonely text without an id")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    out = dict(pipeline.STAGES)["near_duplicates"](spark, docs, SF)
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(map(str, [rows[0], rows[3], rows[4]]))


def test_decontamination_goes_by_the_text_of_a_row(spark):
    item = max((r.text for r in table(spark, SF, "benchmark").collect()), key=lambda t: len(t.split()))
    rows = [(None, f"before it {item} after it", 1), (None, "a clean text without an id", 2),
            (1, f"here {item}", 3), (1, "a clean text of the same id", 4), (2, f"there {item}", 5),
            (3, None, 6), (4, "", 7), (1, "a clean text of the same id", 8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, gone int")
    out = dict(pipeline.STAGES)["decontaminate"](spark, docs, SF)
    assert out.schema == docs.schema
    assert sorted(r.gone for r in out.collect()) == [2, 4, 6, 7, 8]
