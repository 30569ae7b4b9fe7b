"""Incremental loading in batch form: landing zone -> silver table.

One run lists the landed files, leaves out those in the table's ledger, reads
the others, keeps per user what is newer than the user's watermark, and
commits plays, ledger and watermarks together.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from histlake.functions.casts import typed_plays
from histlake.functions.keys import surrogate_key
from histlake.operators.incremental import watermark_load
from histlake.plans.pipelines import to_silver_columns
from histlake.session import scratch_dir, stored
from histlake.sources.landing import REASONS, export_files, parse_documents
from histlake.sources.listing import read_contents
from histlake.sources.silver_table import SilverTable, unprocessed


class Run(NamedTuple):
    """``batch``: the committed number, None if there was nothing to do."""

    batch: int | None
    files: int
    rejects: int


def load_new_files(spark: SparkSession, landing_root: str, table: SilverTable, name: str) -> Run:
    """Take in the landed files that no earlier run has taken."""
    if table.has_batch(name):
        return Run(None, 0, 0)
    listing = export_files(spark, landing_root, content=False).withColumn("basename", F.col("file_name"))
    new = stored(unprocessed(listing, table.ledger()), scratch_dir(spark, "new-files"))
    found = new.count()
    if not found:
        return Run(None, 0, 0)
    exports = parse_documents(read_contents(new))      # only these files are opened
    # read twice, for the plays and for the marks: files are opened and parsed once
    plays = stored(typed_plays(exports.plays.drop("file_name")), scratch_dir(spark, "new-plays"))
    fresh, marks = watermark_load(plays, table.watermarks())
    batch = table.stage(to_silver_columns(surrogate_key(fresh)), files=new, marks=marks)
    rejects = sum(exports.counts.get[r] for r in REASONS)
    if rejects:
        exports.rejects.write.mode("overwrite").parquet(f"{table.root}/rejects/batch={batch}")
    table.commit(batch, name)
    return Run(batch, found, rejects)
