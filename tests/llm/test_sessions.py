from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetlake.llm import chat, decontaminate, html_text, lexical, packing, simhash, suffix_dedup, topk, toxicity, warc
from fleetlake.llm.common import ROOT, prepared

DOCS = [(i, f"word{i} " * 60, f"http://h.org/{i}", f"<p>{i}</p>") for i in range(4)]
CALLS = {
    "hits": lambda d: decontaminate.benchmark_hits(d, d.selectExpr("doc_id item_id", "text")),
    "spans": lambda d: decontaminate.remove_spans(d, d.selectExpr("doc_id item_id", "text")),
    "drop": lambda d: decontaminate.drop_documents(d, d.selectExpr("doc_id item_id", "text")),
    "pack": packing.pack,
    "pages": lambda d: html_text.extract(d.selectExpr("doc_id page_id", "url", "html")),
    "simhash": simhash.fingerprints,
    "warc": lambda d: warc.write_archives(d.selectExpr("doc_id page_id", "url", "html")),
    "toxicity": lambda d: toxicity.severity(d, toxicity.train(d, d.selectExpr("doc_id", "doc_id % 2 grade"))),
    "suffix": suffix_dedup.repeated_passages,
    "chat": lambda d: chat.format_chats(d.selectExpr("doc_id conv_id", "1 turn", "'user' role", "text")),
    "lexical": lambda d: lexical.rank(d, d.selectExpr("doc_id item_id", "text"), 2),
    "top_k": lambda d: topk.top_k(*[d.selectExpr("doc_id vec_id", "array(1D, double(doc_id)) dims")] * 2, 2),
}


@pytest.mark.parametrize("name", CALLS)
def test_tasks_find_the_package_in_a_session_started_elsewhere(spark, monkeypatch, name):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, url string, html string")
    monkeypatch.setitem(spark.sparkContext.environment, "PYTHONPATH", "")
    seen = []
    original = type(docs).mapInArrow

    def spied(self, *args, **kwargs):
        seen.append(spark.sparkContext.environment["PYTHONPATH"])
        return original(self, *args, **kwargs)

    monkeypatch.setattr(type(docs), "mapInArrow", spied)
    CALLS[name](docs).collect()
    assert seen and all(ROOT in paths for paths in seen)


def test_batches_of_long_texts_are_small(spark):
    """Three thousand texts of 4 kB came to a task as one batch, whose buffers stay with the executor."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    texts = prepared(spark).range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 4096).alias("text"))
    found = texts.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in found) == 3000 and max(r.size for r in found) < 8 * 2**20
