"""Queries on streams, sinks and manifests, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.operators import blocks as B
from tallyweave.sources import sinks
from tallyweave.sources.tables import table
from tallyweave.streaming import streams


def q_stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """The events table as a stream, per hour and type. Complete mode: with the whole table in one pass no row is late."""
    return streams.run_all(streams.windowed(streams.table_stream(spark, d, "events"), late="3650 days"))


def q_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Blocks and letters per document and in all; confidence from the block's length."""
    b = B.blocks(table(spark, d, "documents")).withColumn("confidence", F.round(1 - 1 / (F.length("content") + 1), 3))
    return sinks.manifest(b).select("doc_id", "n_blocks", "n_chars", "least", "greatest")


def q_envelopes(spark: SparkSession, d: str) -> DataFrame:
    """An envelope per inventoried file: its order numbers accepted, files of no payable status declined."""
    inv = table(spark, d, "document_inventory").select(F.col("filename").alias("file"), "po_number_candidates", "payable_status")
    po = inv.where("po_number_candidates is not null").select("file", F.explode(F.split("po_number_candidates", "[|]")).alias("po_number"))
    return sinks.envelopes(inv, po, inv.where("payable_status = 'likely_non_payable'").select("file", F.col("payable_status").alias("reason")))


QUERIES = {f.__name__: f for f in (q_stream_windows, q_manifest, q_envelopes)}

SQL = {
    "q_stream_windows": "select date_trunc('hour', ts) as window_start, event_type, count(*) as n_events, sum(cast(value as decimal(18,4))) as total from events group by 1, 2",
    "q_manifest": "with b as (select doc_id, content, round(1 - 1.0 / (length(content) + 1), 3) as c from (select doc_id, unnest(string_split(text, chr(10))) as content from documents) where trim(content) <> '') select doc_id, count(*) as n_blocks, cast(sum(length(content)) as bigint) as n_chars, cast(min(c) as double) as least, cast(max(c) as double) as greatest from b group by rollup(doc_id)",
    "q_envelopes": """with inv as (select filename as file, po_number_candidates as p, payable_status as s from document_inventory),
        a as (select file, string_agg('{"po_number":"' || n || '"}', ',' order by '{"po_number":"' || n || '"}') as t from (select file, unnest(string_split(p, '|')) as n from inv where p is not null) group by 1),
        d as (select file, string_agg('{"reason":"' || s || '"}', ',') as t from inv where s = 'likely_non_payable' group by 1)
        select f.file, '{"file":"' || f.file || '","payables":[' || coalesce(a.t, '') || '],"declined":[' || coalesce(d.t, '') || ']}' as body from (select distinct file from inv where file is not null) f left join a on a.file = f.file left join d on d.file = f.file""",
}
