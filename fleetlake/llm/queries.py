"""The package's registered queries and their SQL counterparts."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from fleetlake.llm import (
    chat,
    decontaminate,
    fill_middle,
    html_text,
    lexical,
    packing,
    pieces,
    simhash,
    suffix_dedup,
    topk,
    toxicity,
    url_filter,
    warc,
)
from fleetlake.llm.common import table

#: Rules of the URL filter: verdict, host, path. Fixed values.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: Text of both turns of conversation -1. Fixed value.
MARKED_TEXT = "</s>[INST] ok [/INST]"


#: The search: neighbours for each query, every how manieth id is a query, and the factor before floor().
NEIGHBOURS, QUERY_EVERY, SCALE = 20, 20, 64

#: Documents for each item of the ranked search.
LEXICAL_BEST = 50


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_text.extract(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(spark, index, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"), SCALE)
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0), NEIGHBOURS)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity_model(spark, docs, sf_dir))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("grade"))
    return toxicity.train(docs, labels)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that share a passage: words removed and kept, and their stretches as ``first-behind`` texts."""
    found = suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))

    def words(spans: str):
        return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])

    def listed(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        words("removed").alias("n_removed"),
        words("kept").alias("n_kept"),
        listed("removed").alias("removed"),
        listed("kept").alias("kept"),
    )


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, formatted, and read back from the output."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame([(-1, 0, "user", MARKED_TEXT), (-1, 1, "assistant", MARKED_TEXT)], rows.schema)
    formatted = chat.format_chats(rows.unionByName(marked))

    def read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for whole, spans in zip(batch["formatted"].to_pylist(), batch["loss_spans"].to_pylist(), strict=True):
                turns = chat.parse(whole)
                loss = "".join(chat.unescape(whole[s["start"] : s["end"]]) for s in spans)
                out.append(
                    (
                        len(turns),
                        _sha256("".join(f"{role}\n{text}\n" for role, text in turns)),
                        len(loss),
                        _sha256(loss),
                        len(whole),
                    )
                )
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch["conv_id"]]
                + [pa.array(c, pa.string() if i in (1, 3) else pa.int64()) for i, c in enumerate(columns)],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(
        read_back,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "verdict string, host string, path string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), LEXICAL_BEST)


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transform(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = pieces.decode(pieces.encode(table(spark, sf_dir, "documents")))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_packing": op2_packing,
    "op3_html_text": op3_html_text,
    "op4_simhash": op4_simhash,
    "op5_warc": op5_warc,
    "op6_top_k": op6_top_k,
    "op7_toxicity": op7_toxicity,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_chat_format": op9_chat_format,
    "op10_url_filter": op10_url_filter,
    "op11_lexical_search": op11_lexical_search,
    "op12_fill_middle": op12_fill_middle,
    "op13_pieces": op13_pieces,
    "pipeline": corpus_pipeline.run,
}

#: The words of a text; backslashes as the SQL engine's expressions want them.
_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

#: The search's terms, with digits as well.
_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

_ESCAPED = r"""
    regexp_replace(replace({0}, '\', '\\'),
        '(<)(\|im_start\|>|\|im_end\|>|s>|/s>|<SYS>>|</SYS>>)|(\[)(INST\]|/INST\])', '\1\3\\\2\4', 'g')
"""

ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": f"""
        WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, least(len(w), {decontaminate.WINDOW}) AS n,
                   list_slice(w, i, i + least(len(w), {decontaminate.WINDOW}) - 1) AS words
            FROM items, unnest(range(1, len(w) - least(len(w), {decontaminate.WINDOW}) + 2)) AS u(i) WHERE len(w) > 0
        ),
        docs AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents),
        runs AS (
            SELECT row, i, n, list_slice(w, i, i + n - 1) AS words
            FROM docs, (SELECT DISTINCT n FROM windows) AS lengths, unnest(range(1, len(w) - n + 2)) AS u(i)
        ),
        hits AS (SELECT row, i, n, item_id FROM runs JOIN windows USING (n, words)),
        covered AS (SELECT row, count(DISTINCT j) AS n_hit FROM hits, unnest(range(i, i + n)) AS u(j) GROUP BY row),
        named AS (
            SELECT row, count(DISTINCT item_id) AS n_items,
                   string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
            FROM hits GROUP BY row
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM docs LEFT JOIN covered USING (row) LEFT JOIN named USING (row)
    """,
    "op5_warc": f"""
        WITH rows AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ),
        firsts AS (
            SELECT *, CASE WHEN payload_bytes >= {warc.MIN_REVISIT_BYTES}
                           THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first
            FROM rows
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM firsts
    """,
    "op6_top_k": f"""
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT q.vec_id AS query_id, e.vec_id, list_dot_product(q.v, e.v)::BIGINT AS score
            FROM whole q JOIN whole e ON q.vec_id <> e.vec_id WHERE q.vec_id % {QUERY_EVERY} = 0
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {NEIGHBOURS}
    """,
    "op8_suffix_dedup": f"""
        WITH texts AS (SELECT DISTINCT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents),
        runs AS (
            SELECT doc_id, i, list_slice(w, i, i + {suffix_dedup.MIN_WORDS - 1}) AS run
            FROM texts, unnest(range(1, len(w) - {suffix_dedup.MIN_WORDS} + 2)) AS u(i)
        ),
        shared AS (SELECT run, min(doc_id) AS first FROM runs GROUP BY run HAVING min(doc_id) <> max(doc_id)),
        words AS (
            SELECT doc_id, j, bool_or(first <> doc_id) AS cut
            FROM runs JOIN shared USING (run), unnest(range(i - 1, i - 1 + {suffix_dedup.MIN_WORDS})) AS u(j)
            GROUP BY doc_id, j
        ),
        numbered AS (SELECT *, j - row_number() OVER (PARTITION BY doc_id, cut ORDER BY j) AS island FROM words),
        spans AS (
            SELECT doc_id, cut, min(j) AS a, count(*) AS n, min(j) || '-' || (max(j) + 1) AS span
            FROM numbered GROUP BY doc_id, cut, island
        )
        SELECT doc_id, coalesce(sum(n) FILTER (cut), 0)::BIGINT AS n_removed,
               coalesce(sum(n) FILTER (NOT cut), 0)::BIGINT AS n_kept,
               coalesce(string_agg(span, ',' ORDER BY a) FILTER (cut), '') AS removed,
               coalesce(string_agg(span, ',' ORDER BY a) FILTER (NOT cut), '') AS kept
        FROM spans GROUP BY doc_id
    """,
    "op9_chat_format": f"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '{MARKED_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{MARKED_TEXT}'
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length('<|im_start|>') + length(role) + 1 + length({_ESCAPED.format("text")})
                   + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
        FROM t GROUP BY conv_id
    """,
    "op10_url_filter": f"""
        WITH rules(verdict, host, path) AS (VALUES {', '.join(map(str, URL_RULES))}),
        parts AS (
            SELECT row_number() OVER () AS row, page_id,
                   translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path,
                   url
            FROM pages
        ),
        fits AS (
            SELECT p.row, arg_max(struct_pack(rule := r.host || r.path, verdict := r.verdict),
                                  length(r.host || r.path)) AS best
            FROM parts p JOIN rules r
              ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
            GROUP BY p.row
        )
        SELECT page_id, url, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
        FROM parts LEFT JOIN fits USING (row)
    """,
    "op11_lexical_search": rf"""
        WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS t FROM documents),
        sizes AS (SELECT row, doc_id, len(t) AS n FROM docs WHERE len(t) > 0),
        totals AS (SELECT count(*) AS docs_n, sum(n)::BIGINT AS docs_l FROM sizes),
        tfs AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(t) AS term FROM docs) GROUP BY row, term),
        dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
        items AS (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS t FROM benchmark),
        asked AS (SELECT DISTINCT item, item_id, term FROM (SELECT item, item_id, unnest(t) AS term FROM items)),
        weighted AS (
            SELECT item, item_id, term, floor(1000 * ln((2 * docs_n + 2) / (2 * df + 1)))::BIGINT AS w
            FROM asked JOIN dfs USING (term), totals
        ),
        scored AS (
            SELECT item, item_id, row, doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs_n) // docs_l))))::BIGINT AS score
            FROM weighted JOIN tfs USING (term) JOIN sizes USING (row), totals
            GROUP BY item, item_id, row, doc_id
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INTEGER AS rank
            FROM scored WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {LEXICAL_BEST}
    """,
    "op12_fill_middle": rf"""
        WITH units AS (
            SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
                   sha256(concat('{fill_middle.SEED}:', doc_id::VARCHAR)) AS h
            FROM documents
        ),
        drawn AS (
            SELECT *, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
                   ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
            FROM units
        ),
        cut AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                             OR h3 % 100 >= {fill_middle.TRANSFORMED} THEN 'plain'
                        WHEN h4 % 100 < {fill_middle.SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
            FROM drawn
        ),
        parts AS (
            SELECT *, array_to_string(list_slice(u, 1, a), '') AS p, array_to_string(list_slice(u, a + 1, b), '') AS m,
                   array_to_string(list_slice(u, b + 1, n), '') AS s
            FROM cut
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                                ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts
    """,
}
