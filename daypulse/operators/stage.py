"""Staging: typed projections of VARIANT paths from declarative column specs."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.feeds import Column as Spec
from ..sources.feeds import FeedSpec, feed


def variant_path(path: str) -> str:
    """``contributors.deep_sleep`` -> ``$.contributors.deep_sleep``."""
    return "$." + path if not path.startswith("$") else path


def project_variant(raw: DataFrame, columns: Iterable[Spec], variant_col: str = "raw_data",
                    strict: bool = False, passthrough: Sequence[str] = ("partition_date",)) -> DataFrame:
    """Project typed columns out of a VARIANT column.

    A missing path or a JSON null gives NULL. A value of the wrong type gives
    NULL in lenient mode (``try_variant_get``) and fails the job in strict
    mode (``variant_get``). An array or object read as ``string`` is its JSON
    text. Passthrough columns absent from ``raw`` are skipped.
    """
    get = F.variant_get if strict else F.try_variant_get
    v = F.col(variant_col)
    cols = [get(v, variant_path(c.path), c.type).alias(c.alias) for c in columns]
    keep = [F.col(c) for c in passthrough if c in raw.columns]
    return raw.select(*cols, *keep)


def stage(raw: DataFrame, name: str | FeedSpec, strict: bool = False,
          keys: Sequence[str] = (), key_type: str = "string") -> DataFrame:
    """Staged table of a registered feed: keys, the spec's columns and ``partition_date``.

    ``keys`` are entity columns: taken from ``raw`` when it has them, else read
    from the record at ``$.<key>`` as ``key_type``.
    """
    spec = name if isinstance(name, FeedSpec) else feed(name)
    from_record = tuple(Spec(k, key_type, k) for k in keys if k not in raw.columns)
    carried = tuple(k for k in keys if k in raw.columns)
    out = project_variant(raw, (*from_record, *spec.columns), strict=strict,
                          passthrough=(*carried, "partition_date"))
    return out.select(*keys, *[c for c in out.columns if c not in keys])


def flatten_array(raw: DataFrame, path: str, variant_col: str = "raw_data",
                  keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of a VARIANT array at ``path`` (with its position)."""
    arr = F.try_variant_get(F.col(variant_col), variant_path(path), "array<variant>")
    return raw.select(*keep, F.posexplode(arr).alias("pos", "value"))
