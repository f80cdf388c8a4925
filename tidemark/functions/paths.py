"""Path columns: Column -> Column, all JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values that must equal the reference's behaviour:
# file names never staged for copy (exact, case-sensitive list)
EXCLUDED_NAMES = ("DICOMDIR", "dicomdir")
# suffix appended to extension-less imaging files
IMAGING_SUFFIX = ".dcm"
# pattern that captures the workspace id of a lake URI
WORKSPACE_PATTERN = r"abfss://([^@]+)@"
# 0-based path segment that holds the lakehouse id
LAKEHOUSE_SEGMENT = 3

# classification labels of a manifest entry
DIRECTORY = "directory"
EXCLUDED = "excluded"
COPY = "copy"
HAS_EXTENSION = "has_extension"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def last_segment(path, rtrim_slash: bool = False) -> Column:
    """Text after the last ``/``; a trailing slash gives ``''`` unless
    ``rtrim_slash`` strips trailing slashes first (then the folder name)."""
    p = _c(path)
    if rtrim_slash:
        p = F.regexp_replace(p, "/+$", "")
    return F.element_at(F.split(p, "/"), -1)


def nth_segment(path, n: int) -> Column:
    """0-based ``n``-th segment of the path; NULL when the path is shorter."""
    return F.get(F.split(_c(path), "/"), F.lit(n))


def regex_group(text, pattern: str, group: int = 1) -> Column:
    """Captured group of the first match; NULL when the pattern does not match."""
    t = _c(text)
    return F.when(t.rlike(pattern), F.regexp_extract(t, pattern, group))


def workspace_id(path) -> Column:
    return regex_group(path, WORKSPACE_PATTERN, 1)


def lakehouse_id(path) -> Column:
    return nth_segment(path, LAKEHOUSE_SEGMENT)


def parent_dir(path) -> Column:
    """Directory part of a file path (everything before the last ``/``)."""
    return F.regexp_replace(_c(path), "/[^/]*$", "")


def join_path(directory, *names) -> Column:
    """``directory.rstrip('/') + '/' + name [+ '/' + name ...]``.

    ``directory`` is a literal when given as ``str``, else a Column; names are
    column names or Columns.
    """
    if isinstance(directory, str):
        parts = [F.lit(directory.rstrip("/"))]
    else:
        parts = [F.regexp_replace(directory, "/+$", "")]
    for n in names:
        parts += [F.lit("/"), _c(n)]
    return F.concat(*parts)


def with_suffix(name, suffix: str = IMAGING_SUFFIX) -> Column:
    return F.concat(_c(name), F.lit(suffix))


def has_extension(name) -> Column:
    return _c(name).contains(".")


def classify_entry(name, is_dir=None, exclude=EXCLUDED_NAMES,
                   copy_with_extension: bool = False) -> Column:
    """Three-way staging decision for one manifest entry.

    directory -> ignored; exact name in ``exclude`` -> excluded; no dot in the
    name -> copy (gets the suffix); otherwise skipped as already having an
    extension, or copied unchanged when ``copy_with_extension``.
    """
    n = _c(name)
    rule = F.when(n.isin(*exclude), F.lit(EXCLUDED)).when(~has_extension(n), F.lit(COPY))
    rule = rule.otherwise(F.lit(COPY if copy_with_extension else HAS_EXTENSION))
    if is_dir is not None:
        rule = F.when(_c(is_dir), F.lit(DIRECTORY)).otherwise(rule)
    return rule


def staged_name(name, suffix: str = IMAGING_SUFFIX) -> Column:
    """Name under which a copied file lands: suffix only when it has no dot."""
    n = _c(name)
    return F.when(has_extension(n), n).otherwise(with_suffix(n, suffix))
