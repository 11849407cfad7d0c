"""Location split + explode + province lookup.

The keyword lookups are generated as SQL CASE expressions over the fixed
rule tables (one expression per lookup, code-generated where it is not
inside an array lambda).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules as R
from ..functions.hashing import job_hash_clean
from ..functions.text import WS_CHARS, first_match_sql, sql_str, title_case


def _strip_sql(x: str) -> str:
    return f"btrim({x}, {sql_str(WS_CHARS)})"


def _num(v) -> str:
    return "CAST(NULL AS DOUBLE)" if v is None else f"CAST({float(v)!r} AS DOUBLE)"


def _lookup_sql(x: str, pairs, cast_double: bool = False) -> str:
    """``CASE x WHEN k THEN v ... END`` for a fixed table."""
    val = _num if cast_double else sql_str
    return f"(CASE {x} " + " ".join(f"WHEN {sql_str(k)} THEN {val(v)}" for k, v in pairs) + " END)"


def _merge_rules_v2():
    return [(prov, (key,)) for key, prov in R.PROVINCE_MERGE_V2]


def geo_explode_v2(df: DataFrame, location: str = "ViTri", link: str = "LinkBaiTuyenDung",
                   order_col: str | None = None, links_unique: bool = True) -> DataFrame:
    """One row per (posting, merged province); postings without a known
    province are dropped.

    Parts are split on ``[;|,]`` and kept only if they contain a province
    key.  Repeated provinces inside one posting are removed inside the row
    (no shuffle).  When the same link may occur in several input rows
    (``links_unique=False``) the first row by ``order_col`` wins: a
    ``min_by`` aggregate on (link, province), combined map-side.
    """
    parts = (f"filter(transform(split(coalesce(`{location}`, 'None'), '[;|,]'), p -> {_strip_sql('p')}), "
             f"p -> p != '')")
    prov = first_match_sql("x.low", _merge_rules_v2(), None)  # the lowered part, made once
    lows = f"transform({parts}, p -> named_struct('part', p, 'low', lower(p)))"
    kept = f"filter(transform({lows}, x -> named_struct('part', x.part, 'prov', {prov})), x -> x.prov IS NOT NULL)"
    out = df.withColumn("__geo_kept", F.expr(kept))
    first = "filter(__geo_kept, (x, i) -> NOT exists(slice(__geo_kept, 1, i), y -> y.prov = x.prov))"
    out = out.select("*", F.posexplode(F.expr(first)).alias("_pos", "_g")).drop("__geo_kept")
    coords = [(p, (r, la, lo)) for p, r, la, lo in R.PROVINCE_COORD_V2]
    p = "_g.prov"
    out = out.select(
        *df.columns, "_pos",
        title_case(F.col("_g.part")).alias("ViTri_clean"),
        F.col(p).alias("Tinh_Thanh"),
        F.expr(f"coalesce({_lookup_sql(p, [(k, v[0]) for k, v in coords])}, 'Khác')").alias("KhuVuc"),
        F.expr(_lookup_sql(p, [(k, v[1]) for k, v in coords], True)).alias("Latitude"),
        F.expr(_lookup_sql(p, [(k, v[2]) for k, v in coords], True)).alias("Longitude"),
    )
    if not links_unique:
        if order_col is None:
            raise ValueError("order_col is required when links are not unique")
        from .dedupe import first_per_key
        out = first_per_key(out, [link, "Tinh_Thanh"], [order_col, "_pos"])
    return out.drop("_pos")


def with_clean_hash(df: DataFrame, link: str = "LinkBaiTuyenDung") -> DataFrame:
    return df.withColumn("JobHash", job_hash_clean(F.col(link), F.col("Tinh_Thanh")))


def geo_explode_v1(df: DataFrame, location: str = "ViTri") -> DataFrame:
    """One row per location part (split on ``[;,|&]`` or " - "); postings
    without a usable location keep one row with province "Khác".

    Province: exact key, else first contained key, else the raw part.
    Coordinates are those of the original province (own table).
    """
    parts = (f"filter(transform(split(`{location}`, '[;,|&]|\\\\s+-\\\\s+'), p -> {_strip_sql('p')}), "
             f"p -> p != '')")
    out = df.select("*", F.explode_outer(F.expr(parts)).alias("_part"))
    out = out.withColumn("_loc", F.expr(_strip_sql("lower(_part)")))
    merge_exact = _lookup_sql("_loc", R.PROVINCE_MERGE_V1)
    merge_first = first_match_sql("_loc", [(prov, (key,)) for key, prov in R.PROVINCE_MERGE_V1], None)
    idx = [(e[0], str(i)) for i, e in enumerate(R.PROVINCE_COORD_V1)]
    coord_exact = f"(CASE _loc " + " ".join(f"WHEN {sql_str(k)} THEN {i}" for k, i in idx) + " END)"
    coord_first = first_match_sql("_loc", [(i, (k,)) for k, i in idx], None)
    out = out.withColumn("_prov", F.expr(f"coalesce({merge_exact}, {merge_first})")).withColumn(
        "_ci", F.expr(f"CAST(coalesce({coord_exact}, {coord_first}) AS INT)"))

    def coord(field: int, cast_double: bool):
        return F.expr(_lookup_sql("_ci", [(i, e[field]) for i, e in
                                          ((str(j), x) for j, x in enumerate(R.PROVINCE_COORD_V1))], cast_double)
                      .replace("CASE _ci WHEN '", "CASE CAST(_ci AS STRING) WHEN '"))

    missing = F.col("_part").isNull()
    return out.select(
        *df.columns,
        F.when(missing, F.lit(None).cast("string")).otherwise(F.coalesce(coord(4, False), F.col("_part"))).alias("ViTri_clean"),
        F.when(missing, F.lit("Khác")).otherwise(F.coalesce(F.col("_prov"), F.col("_part"))).alias("Tinh_Thanh"),
        F.coalesce(coord(1, False), F.lit("Khác")).alias("KhuVuc"),
        coord(2, True).alias("Latitude"),
        coord(3, True).alias("Longitude"),
    )
