"""Audit / lineage columns."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import clock

# Fixed values that must equal the reference's behaviour: audit column names
PIPELINE_NAME_COL = "_createdByPipelineName"
PIPELINE_RUN_COL = "_createdByPipelineRunID"
MODIFIED_COL = "_lastModifieddttm"


def add_audit_columns(df: DataFrame, pipeline_name: str, run_id: str,
                      as_of: _dt.datetime | None = None) -> DataFrame:
    """Pipeline name, run id and a last-modified stamp (now, or injected)."""
    return df.withColumns({
        PIPELINE_NAME_COL: F.lit(pipeline_name),
        PIPELINE_RUN_COL: F.lit(run_id),
        MODIFIED_COL: clock(as_of),
    })


def stable_id(*parts) -> Column:
    """Deterministic text id of a record from its natural key (unlike a
    generated id on a one-row frame, which repeats)."""
    cols = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return F.sha2(F.concat_ws("|", *cols), 256)
