"""Work queues over the page state (W1-W5) and their breakdown (Q7).

All queues hold ACTIVE pages only. FAILED always re-queues (no retry cap);
a NULL stage status matches no queue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ACTIVE, FAILED, PENDING, SUCCESS

WAITING = (PENDING, FAILED)  # statuses that put a page in a queue

# stage column of each queue and the stages that must have succeeded first
QUEUES = {
    "extract": ("extracted", ()),
    "summary": ("summarized", ()),           # does not wait for extraction
    "embed": ("embedded", ("extracted", "summarized")),
    "index": ("indexed", ("embedded",)),
}


def queue_condition(name: str) -> F.Column:
    stage, needs = QUEUES[name]
    cond = (F.col("status") == ACTIVE) & F.col(stage).isin(*WAITING)
    for n in needs:
        cond = cond & (F.col(n) == SUCCESS)
    return cond


def queue(pages: DataFrame, name: str) -> DataFrame:
    """Pages waiting for stage ``name`` (extract/summary/embed/index)."""
    return pages.filter(queue_condition(name))


def queue_breakdown(pages: DataFrame) -> DataFrame:
    """Q7: for every queue, how many pages are new (PENDING) or retries (FAILED).

    One pass: each page is tagged with the queues it is in, then counted.
    """
    tagged = pages.select(F.explode(F.array(*[
        F.when(queue_condition(n), F.struct(F.lit(n).alias("queue"),
                                            F.col(QUEUES[n][0]).alias("stage_status")))
        for n in QUEUES])).alias("t")).filter(F.col("t").isNotNull())
    return tagged.groupBy("t.queue", "t.stage_status").agg(F.count(F.lit(1)).alias("n"))


def queue_split(registry: DataFrame, pages: DataFrame) -> DataFrame:
    """ACTIVE documents that have no page rows yet."""
    act = registry.filter(F.col("status") == ACTIVE).select("doc_id", "path", "content_hash")
    return act.join(pages.select("doc_id").distinct(), "doc_id", "left_anti")


def queue_index_for_model(pages: DataFrame, index: DataFrame, model: str) -> DataFrame:
    """W4 scoped to an embedding model: the index queue plus
    ACTIVE embedded pages whose index row is missing or was written by
    another model, even though their ``indexed`` says SUCCESS."""
    current = index.filter(F.col("model") == model).select("page_id")
    stale = (pages.filter((F.col("status") == ACTIVE) & (F.col("embedded") == SUCCESS)
                          & (F.col("indexed") == SUCCESS))
             .join(current, "page_id", "left_anti"))
    return queue(pages, "index").unionByName(stale)
