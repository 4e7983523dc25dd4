from collections import Counter

import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlens.llm import quality, secrets
from ledgerlens.llm.queries import PIECE_MODEL
from tests.llm.helpers import SF, components, no_rows, odd_rows
from tests.llm.test_mixing import targets


def test_against_plain_version(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    good = quality.ledger(rows).filter(quality.passes(F.col("failed"))).collect()
    texts = {r.doc_id: docs[r.doc_id].text for r in good}
    component = components(texts, 5, 80)
    texts = {i: secrets.redacted(t.encode()) for i, t in texts.items() if component[i] == i}
    sizes = Counter()
    for i, t in texts.items():
        sizes[docs[i].source] += len(t.encode().split())
    goal = targets(dict(sizes))
    out = corpus_pipeline.run(spark, SF).collect()

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    given = Counter()
    for r in out:
        text = library.decode(r.ids)
        assert r.doc_id in texts and texts[r.doc_id].startswith(text) and library.encode(text) == r.ids
        given[docs[r.doc_id].source] += len(text.encode().split())
    for source, t in goal.items():
        assert abs(given[source] - t) <= 1
    uses = Counter(r.doc_id for r in out)
    assert max(uses.values()) <= 2


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_odd_and_no_rows(spark):
    for df in (odd_rows(spark), no_rows(spark)):
        for _, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, SF)
        assert df.count() == 0  # every odd row is too short or repeats itself
