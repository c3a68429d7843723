"""STM-1: landed pages as a stream -> bronze lifecycle + pull audit.

``readStream`` over the landing folder (explicit schema), ``Trigger.AvailableNow``
to drain whatever has landed and stop — the daily batch cadence of the
original, with Spark's checkpointed file log deciding which files are new —
and ``foreachBatch`` running the replay-safe :func:`jobmart.plans.jobs.ingest_pages`.

The pages of a pull may land in any number of micro-batches: every good page is
ingested with the batch it comes in, and the audit adds the batches of a pull up.

A checkpoint numbers its micro-batches from 0, so their rows are kept under the id
that Spark gives the checkpoint's query: a second checkpoint on the same tables, or a
new one after the old was deleted, writes partitions of its own. Pages that it brings
again are folded away like any repeated sighting.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession

from jobmart.plans import jobs
from jobmart.sources.pages import LANDED_READ_SCHEMA, stream_landed_files


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that owns a checkpoint: the same after a restart, new in a new checkpoint."""
    return json.loads(spark.read.text(os.path.join(checkpoint, "metadata")).first()[0])["id"]


def start_page_ingest(spark: SparkSession, landing_dir: str, root: str, checkpoint: str | None = None,
                      available_now: bool = True, max_files_per_trigger: int | None = None,
                      layout: str = "log"):
    """Start the ingest stream.

    ``layout``: ``"log"`` = JSON-lines page log, ``"files"`` = one raw response file
    per page with the pull keys in the path. ``max_files_per_trigger`` bounds each
    micro-batch; a pull may span several.
    """
    opts = {"maxFilesPerTrigger": max_files_per_trigger} if max_files_per_trigger else {}
    if layout == "files":
        stream = stream_landed_files(spark, landing_dir, **opts)
    else:
        reader = spark.readStream.schema(LANDED_READ_SCHEMA)
        for k, v in opts.items():
            reader = reader.option(k, v)
        stream = reader.json(landing_dir)
    # The stream's file log lives next to the tables it feeds (the same shared root).
    checkpoint = checkpoint or os.path.join(root, "_streams", "page_ingest")

    def each(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            jobs.ingest_pages(spark, batch, root, batch_id, query_id(spark, checkpoint))

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
