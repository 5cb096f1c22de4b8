"""Continuous ingest of notifications into stored history."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from chronoctx import model as M
from chronoctx.operators import parse as P
from chronoctx.options import Options
from chronoctx.plans.pipelines import history_of
from chronoctx.sinks import versions as V
from chronoctx.sinks.files import with_day, write_batch
from chronoctx.streaming.runtime import kept


def history_writer(
    out: str, store: str = "postgresql", opts: Options = Options(), persistence: str = "row", names=None
) -> Callable[[DataFrame, int], None]:
    """Batch handler: rows to ``<out>/history``, notifications that were not
    accepted to ``<out>/dead_letter``, rows without a valid destination to
    ``<out>/misnamed``. A notification is parsed once for all three."""
    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = kept(P.parse(batch, opts))
        try:
            outcome = history_of(parsed, store, opts, persistence, names)
            write_batch(outcome.accepted, f"{out}/history", batch_id)
            write_batch(outcome.rejects, f"{out}/dead_letter", batch_id)
            write_batch(outcome.misnamed.select(*_flat(outcome.misnamed)), f"{out}/misnamed", batch_id)
        finally:
            parsed.unpersist()

    return write


def version_writer(
    root: str, job: str, store: str = "postgresql", opts: Options = Options(), persistence: str = "row", names=None
) -> Callable[[DataFrame, int], None]:
    """Batch handler: history, dead letters and misnamed rows of a batch become
    visible in one version of the store ``root`` (``sinks.versions``), or none of
    them. The version has the job and the batch as its token, so a repeated batch adds nothing;
    for the same reason parts of a batch cannot be tried one by one."""
    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = kept(P.parse(batch, opts))
        try:
            outcome = history_of(parsed, store, opts, persistence, names)
            rows = with_day(outcome.accepted) if M.RECV_TIME_TS in outcome.accepted.columns else outcome.accepted
            tables = {"history": rows, "dead_letter": outcome.rejects, "misnamed": outcome.misnamed.select(*_flat(outcome.misnamed))}
            V.commit(batch.sparkSession, root, tables, token=f"{job}-{batch_id}")
        finally:
            parsed.unpersist()

    write.stateful = True
    return write


def _flat(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("md", "attrs", "sub_attrs")]
