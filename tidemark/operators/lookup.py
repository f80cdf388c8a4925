"""Set-based lookups.

The reference answers "was this folder processed?", "where does this folder
route?" and "is this schema registered?" one key at a time on the driver. Here
each is one join over all keys. The small side (history keys, routing table,
registry) is broadcast only after its row count is checked against a bound;
beyond the bound the join stays a shuffle join (sort-merge / shuffle-hash,
with AQE skew handling), so a history that grows without limit never lands in
executor memory whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.text import check_layer

# Largest small side that is broadcast; above either bound the plan stays a
# shuffle join. Both are checked on the actual rows, not on estimates.
BROADCAST_ROW_LIMIT = 2_000_000
BROADCAST_BYTE_LIMIT = 64 * 1024 * 1024

ROUTE_COLUMNS = ("table", "source_file_path", "full_target_path", "processed_file_path", "failed_file_path")


def within_rows(df: DataFrame, max_rows: int, max_bytes: int | None = None) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (and, if given, at most
    ``max_bytes`` bytes, measured as the rows' JSON text). Counts and sizes are
    summed per task first, so no task sees more than its own rows."""
    if max_bytes is None:
        return df.count() <= max_rows
    size = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    return r["n"] <= max_rows and (r["b"] or 0) <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT,
                      max_bytes: int = BROADCAST_BYTE_LIMIT) -> DataFrame:
    """``broadcast(df)`` when its row count and byte size are proven within the
    bounds, else ``df`` unchanged (the join then stays a shuffle join)."""
    return F.broadcast(df) if within_rows(df, max_rows, max_bytes) else df


def processed_keys(history: DataFrame, hist_col: str = "source_folder") -> DataFrame:
    """Distinct folders the history counts as done.

    A folder with failed files is not done (it is retried), when the history
    carries a ``files_failed`` column; older rows without it count as done.
    """
    h = history
    if "files_failed" in h.columns:
        h = h.filter(F.coalesce(F.col("files_failed"), F.lit(0)) == 0)
    return h.select(F.col(hist_col).alias("_done_key")).distinct()


def unprocessed_folders(folders: DataFrame, history: DataFrame, folder_col: str = "folder",
                        hist_col: str = "source_folder",
                        max_broadcast_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Folders not yet in the history (left anti join on the folder name).

    NULL folders are kept (NULL never equals a history key), as the per-key
    ``==`` filter of the original also never matches them.
    """
    keys = bounded_broadcast(processed_keys(history, hist_col), max_broadcast_rows)
    return folders.join(keys, folders[folder_col] == keys["_done_key"], "left_anti")


def rows_of_unprocessed_folders(rows: DataFrame, history: DataFrame, folder_col: str = "folder",
                                hist_col: str = "source_folder",
                                max_broadcast_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Rows (files) whose folder is not yet in the history, for many rows per folder.

    Within the bound, the history keys are broadcast and the anti join is a
    map-side hash lookup on the file rows: no shuffle at all, so a folder
    holding a third of all files costs nothing extra. Beyond it, the rows are
    first reduced to their distinct folders (partial aggregation), only those
    meet the large history in a shuffle join, and the rows are semi-joined
    back to the new folders (broadcast when that list is proven small).
    """
    keys = processed_keys(history, hist_col)
    if within_rows(keys, max_broadcast_rows, BROADCAST_BYTE_LIMIT):
        return rows.join(F.broadcast(keys), rows[folder_col] == keys["_done_key"], "left_anti")
    folders = rows.select(F.col(folder_col).alias("_new_folder")).distinct()
    new = folders.join(keys, folders["_new_folder"] == keys["_done_key"], "left_anti")
    new = bounded_broadcast(new, max_broadcast_rows)
    return rows.join(new, rows[folder_col].eqNullSafe(new["_new_folder"]), "left_semi")


def seen_folders(folders: DataFrame, history: DataFrame, folder_col: str = "folder",
                 hist_col: str = "source_folder", flag_col: str = "processed",
                 max_broadcast_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Every folder with a boolean: is it in the history already (EXISTS)?"""
    keys = bounded_broadcast(processed_keys(history, hist_col), max_broadcast_rows)
    joined = folders.join(keys, folders[folder_col] == keys["_done_key"], "left")
    return joined.withColumn(flag_col, F.col("_done_key").isNotNull()).drop("_done_key")


def _one_route_per_folder(mapping: DataFrame, folder_col: str, layer_col: str,
                          cols=ROUTE_COLUMNS) -> DataFrame:
    """Deterministic single row per (folder, layer): the smallest route tuple.
    Aggregates partially map-side, so a folder listed many times costs little."""
    packed = F.min(F.struct(*[F.col(c) for c in cols])).alias("_route")
    return (mapping.groupBy(folder_col, layer_col).agg(packed)
            .select(folder_col, layer_col, *[F.col("_route")[c].alias(c) for c in cols]))


def route_all(probe: DataFrame, mapping: DataFrame, folder_col: str = "folder",
              layer: str = "bronze", map_folder_col: str = "folder",
              layer_col: str = "layer", cols=ROUTE_COLUMNS,
              max_broadcast_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Every probe row with its route for one layer (route columns NULL when the
    folder has no route): one left join, one pass over the probe."""
    layer = check_layer(layer)
    routes = _one_route_per_folder(mapping.filter(F.col(layer_col) == F.lit(layer)),
                                   map_folder_col, layer_col, cols)
    routes = routes.withColumnRenamed(map_folder_col, "_route_folder").drop(layer_col)
    routes = bounded_broadcast(routes, max_broadcast_rows)
    joined = probe.join(routes, probe[folder_col] == routes["_route_folder"], "left")
    return joined.withColumn("_routed", F.col("_route_folder").isNotNull()).drop("_route_folder")


def route_sources(probe: DataFrame, mapping: DataFrame, folder_col: str = "folder",
                  layer: str = "bronze", map_folder_col: str = "folder",
                  layer_col: str = "layer", cols=ROUTE_COLUMNS,
                  max_broadcast_rows: int = BROADCAST_ROW_LIMIT):
    """Route every probe row through the mapping table for one layer.

    Returns ``(routed, rejects)``: rows with a route carry the route columns;
    rows whose folder has no route for the layer go to ``rejects`` (instead of
    failing on a missing first row). Both halves come from one join; use
    :func:`route_all` when one frame with a flag is enough.
    """
    joined = route_all(probe, mapping, folder_col, layer, map_folder_col, layer_col, cols,
                       max_broadcast_rows)
    routed = joined.filter(F.col("_routed")).drop("_routed")
    rejects = joined.filter(~F.col("_routed")).select(*probe.columns)
    return routed, rejects


def route_first(mapping: DataFrame, folder: str, layer: str = "bronze",
                folder_col: str = "folder", layer_col: str = "layer",
                cols=ROUTE_COLUMNS) -> DataFrame:
    """The route of one folder: filter on both keys (pushed into the scan),
    project the route columns, first row (LIMIT 1). Zero rows when unknown."""
    layer = check_layer(layer)
    cond = (F.col(folder_col) == F.lit(folder)) & (F.col(layer_col) == F.lit(layer))
    return mapping.filter(cond).select(*cols).limit(1)


def lookup_route(mapping: DataFrame, folder: str, layer: str = "bronze", **kw):
    """Driver-side convenience: the 5-tuple of :func:`route_first`, or ``None``."""
    row = route_first(mapping, folder, layer, **kw).first()
    return None if row is None else tuple(row)


def schema_exists(candidates: DataFrame, registry: DataFrame, col: str = "schemaDefinition",
                  flag_col: str | None = None,
                  max_broadcast_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Candidates whose schema text is already registered (left semi join on the
    text alone, not the table name). With ``flag_col``, every candidate is kept
    with a boolean instead."""
    reg = bounded_broadcast(registry.select(F.col(col).alias("_reg_schema")).distinct(),
                            max_broadcast_rows)
    cond = candidates[col] == reg["_reg_schema"]
    if flag_col is None:
        return candidates.join(reg, cond, "left_semi")
    joined = candidates.join(reg, cond, "left")
    return joined.withColumn(flag_col, F.col("_reg_schema").isNotNull()).drop("_reg_schema")
