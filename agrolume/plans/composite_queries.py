"""Registered queries: composites, resampling, grid checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume.functions import masks
from agrolume.operators import composite, grid, raster
from agrolume.plans.registry import query
from agrolume.plans.world import World, add_table

c = F.col
KEYS = ["site", "source_no"]
CELL = [*KEYS, "rw", "cl"]
_BANDS = ["green_dn", "red_dn", "nir_dn", "swir_dn"]

add_table(
    "rs_px",
    "pixels optical scenes",
    "select s.site, p.source_no, p.rw, p.cl, s.acq_date, p.scene_id, o.mask, p.green_dn, p.red_dn, p.nir_dn, p.swir_dn "
    "from pixels p join optical o on o.scene_id = p.scene_id and o.rw = p.rw and o.cl = p.cl "
    "join scenes s on s.scene_id = p.scene_id where p.source_no in (2, 3, 4)",
)
add_table(
    "composite",
    "rs_px",
    "select site, source_no, rw, cl, mask, scene_id, acq_date, green_dn, red_dn, nir_dn, swir_dn from (select *, row_number() over ("
    "partition by site, source_no, rw, cl order by case when mask in (1,4) then 0 when mask <> 0 then 1 else 2 end, "
    "case when mask in (1,4) then -(acq_date - date '1970-01-01') else acq_date - date '1970-01-01' end, scene_id) as rn from rs_px) s where rn = 1",
)


def resourcesat_pixels(w: World) -> DataFrame:
    dated = w.scenes.select("scene_id", "site", "acq_date")
    masked = w.pixels.where("source_no in (2, 3, 4)").withColumn("mask", masks.source_mask())
    return masked.select("scene_id", "source_no", "rw", "cl", "mask", *_BANDS).join(dated, "scene_id")


def site_composite(w: World) -> DataFrame:
    return composite.best_available(resourcesat_pixels(w), keys=CELL, bands=_BANDS)


@query(
    "best_available_composite",
    "select site, source_no, rw, cl, mask, case when mask <> 0 then scene_id end as scene_id, case when mask <> 0 then acq_date end as acq_date, "
    "case when mask <> 0 then green_dn else 0 end as green_dn, case when mask <> 0 then red_dn else 0 end as red_dn, "
    "case when mask <> 0 then nir_dn else 0 end as nir_dn, case when mask <> 0 then swir_dn else 0 end as swir_dn from composite",
    tables="composite",
)
def best_available_composite(w: World) -> DataFrame:
    return site_composite(w)


add_table(
    "comp_metrics",
    "composite",
    "select site, source_no, count(*) as aoi_px, count(case when mask <> 0 then 1 end) as covered_px, "
    "count(case when mask in (1,4) then 1 end) as usable_px, count(case when mask in (2,3) then 1 end) as cloud_masked_px, "
    "round(count(case when mask <> 0 then 1 end)*100e0/count(*), 6) as coverage_percent, "
    "round(count(case when mask in (1,4) then 1 end)*100e0/count(*), 6) as usable_percent, "
    "round(count(case when mask in (2,3) then 1 end)*100e0/count(*), 6) as cloud_masked_percent from composite group by site, source_no",
)


@query(
    "composite_metrics",
    "select m.*, s.scene_id, s.acq_date from comp_metrics m join (select distinct site, source_no, scene_id, acq_date from rs_px) s "
    "on s.site = m.site and s.source_no = m.source_no",
    tables="comp_metrics",
)
def composite_metrics(w: World) -> DataFrame:
    """Metrics of each composite, one row per contributing scene."""
    measured = composite.metrics(site_composite(w), keys=KEYS)
    behind = composite.contributors(resourcesat_pixels(w), keys=KEYS)
    return measured.join(behind, KEYS)


@query(
    "composite_policy",
    "select site, source_no, coverage_percent, case source_no when 3 then 0e0 else 95e0 end as min_coverage_percent, "
    "concat_ws(',', case source_no when 3 then 'partial_aoi_coverage_expected' when 4 then 'coarse_regional_source' end, "
    "case when coverage_percent < case source_no when 3 then 0 else 95 end then 'coverage_below_threshold' end) as warnings from comp_metrics",
    tables="comp_metrics",
)
def composite_policy(w: World) -> DataFrame:
    measured = composite.metrics(site_composite(w), keys=KEYS)
    return composite.policy_warnings(measured, c("source_no")).select(
        "site", "source_no", "coverage_percent", "min_coverage_percent", "warnings"
    )


_NATIVE = "case source_no when 2 then 235e-1 when 3 then 58e-1 else 56e0 end"
_TOLERANCE = "case source_no when 3 then 1e0 else 2e0 end"


@query(
    "composite_verify",
    "select site, source_no, p as problems, p = '' as ok from (select site, source_no, concat_ws('; ', "
    "case when site % 11 = 0 then 'composite manifest missing fields: schema_version' end, "
    "case when site % 13 = 0 then 'composite manifest must set composite=true' end, "
    f"case when site % 4 * 9e-1 > {_TOLERANCE} then 'composite resolution differs from expected' end, "
    "case when bad > 0 then 'unexpected mask classes' end, "
    "case when site % 3 = 0 then 'manifest coverage does not match mask coverage' end, "
    "case when site % 5 = 0 then 'manifest usable coverage does not match mask usable coverage' end, "
    "case when coverage_percent <= 0 then 'composite has no covered pixels inside the configured AOI' end) as p from "
    "(select m.*, 0 as bad from comp_metrics m) s) t",
    tables="comp_metrics",
)
def composite_verify(w: World) -> DataFrame:
    """Recompute each composite and judge a manifest that is wrong in places."""
    made = site_composite(w)
    bad = made.groupBy(*KEYS).agg(F.count_if(~c("mask").isin(*composite.ALLOWED_CLASSES)).alias("bad_class_px"))
    measured = composite.metrics(made, keys=KEYS).join(bad, KEYS)
    declared = measured.selectExpr(
        "site", "source_no",
        "case when site % 11 <> 0 then 'v1' end as schema_version",
        "site % 13 <> 0 as composite",
        f"{_NATIVE.replace('e-1', 'E-1D').replace('e0', 'E0D')} + site % 4 * 0.9D as resolution",
        "coverage_percent + if(site % 3 = 0, 0.5D, 0.0D) as coverage_percent",
        "usable_percent + if(site % 5 = 0, -0.5D, 0.0D) as usable_percent",
    )
    expected = F.when(c("source_no") == 2, 23.5).when(c("source_no") == 3, 5.8).otherwise(56.0)
    tolerance = F.when(c("source_no") == 3, 1.0).otherwise(2.0)
    return composite.verify(declared, measured, keys=KEYS, expected_res=expected, tolerance=tolerance)


# --- resampling --------------------------------------------------------------


def half_targets(w: World) -> DataFrame:
    """Cells of a grid twice as fine, for every covered source cell."""
    fine = F.inline(F.array(*[
        F.struct((c("rw") * 2 + dr).alias("tr"), (c("cl") * 2 + dc).alias("tc")) for dr in (0, 1) for dc in (0, 1)
    ]))
    base = w.pixels.where("source_no = 0").select("scene_id", "rw", "cl")
    return base.select("scene_id", fine).select("scene_id", c("tr").alias("rw"), c("tc").alias("cl"))


add_table(
    "half_targets",
    "pixels",
    "select scene_id, rw*2 + dr as rw, cl*2 + dc as cl from (select scene_id, rw, cl from pixels where source_no = 0) p, "
    "(values (0), (1)) as a(dr), (values (0), (1)) as b(dc)",
)


@query(
    "resample_nearest",
    "select t.scene_id, t.rw, t.cl, p.scl from half_targets t left join pixels p on p.scene_id = t.scene_id and p.source_no = 0 "
    "and p.rw = floor((t.rw + 5e-1)*5e-1) and p.cl = floor((t.cl + 5e-1)*5e-1)",
    tables="half_targets pixels",
)
def resample_nearest(w: World) -> DataFrame:
    """20 m mask classes onto the 10 m grid."""
    source = w.pixels.where("source_no = 0").select("scene_id", "rw", "cl", "scl")
    return grid.resample_nearest(half_targets(w), source, ratio=0.5, values=["scl"])


@query(
    "resample_bilinear",
    "select scene_id, rw, cl, round(sum(wt*v)/sum(wt), 9) as red from (select t.scene_id, t.rw, t.cl, "
    "case when dr = 1 then y - floor(y) else 1 - (y - floor(y)) end * case when dc = 1 then x - floor(x) else 1 - (x - floor(x)) end as wt, p.red as v "
    "from (select *, (rw + 5e-1)*5e-1 + 1e-1 - 5e-1 as y, (cl + 5e-1)*5e-1 + 1e-1 - 5e-1 as x from half_targets) t, "
    "(values (0), (1)) as a(dr), (values (0), (1)) as b(dc), optical p where p.source_no = 0 and p.red is not null "
    "and p.scene_id = t.scene_id and p.rw = floor(y) + dr and p.cl = floor(x) + dc) s group by scene_id, rw, cl",
    tables="half_targets optical",
)
def resample_bilinear(w: World) -> DataFrame:
    """20 m reflectance onto a 10 m grid that is offset by a tenth of a cell."""
    source = raster.optical(w.pixels.where("source_no = 0")).select("scene_id", "rw", "cl", "red")
    out = grid.resample_bilinear(half_targets(w), source, ratio=0.5, shift=0.1, value="red")
    return out.withColumn("red", F.round("red", 9))


@query(
    "grid_alignment_check",
    "select scene_id, count(*) as grids, count(*) = 1 as aligned from (select distinct scene_id, w, h, x0 from (select scene_id, b, 12 as w, "
    "case when scene_id % 19 = 0 and b = 2 then 11 else 12 end as h, x0 + case when scene_id % 23 = 0 and b = 3 then 5e-1 else 0e0 end as x0 "
    "from scenes, (values (1), (2), (3), (4)) as t(b)) s) d group by scene_id",
    tables="scenes",
)
def grid_alignment_check(w: World) -> DataFrame:
    bands = w.scenes.select("scene_id", "x0", F.explode(F.array(*[F.lit(b) for b in (1, 2, 3, 4)])).alias("band_no"))
    grids = bands.selectExpr(
        "scene_id", "band_no", "12 as w",
        "if(scene_id % 19 = 0 and band_no = 2, 11, 12) as h",
        "x0 + if(scene_id % 23 = 0 and band_no = 3, 0.5D, 0.0D) as x0",
    )
    return grid.alignment(grids, key="scene_id", grid=["w", "h", "x0"])


@query(
    "axis_regularity",
    "select source_no, count(*) as steps, median(step) as spacing, median(step) <> 0 and max(abs(step - med)) <= 1e-6 + abs(any_value(med))*1e-6 as uniform "
    "from (select *, median(step) over (partition by source_no) as med from (select source_no, v - lag(v) over (partition by source_no order by p) as step "
    "from (select o_custkey % 7 as source_no, o_orderkey as p, cast(o_orderkey*3 as double) + case when o_custkey % 7 = 3 and o_orderkey % 50 = 0 then 1e-3 else 0e0 end as v "
    "from (select o_orderkey, s.k as o_custkey from orders, (values (0), (1), (2), (3)) as s(k)) o) q) r where step is not null) t group by source_no",
)
def axis_regularity(w: World) -> DataFrame:
    """Four long coordinate axes, one of them with irregular steps."""
    axes = w.table("orders").select(
        c("o_orderkey").alias("p"), F.explode(F.array(*[F.lit(i).cast("long") for i in range(4)])).alias("source_no")
    )
    coords = axes.selectExpr(
        "source_no", "p", "cast(p*3 as double) + if(source_no = 3 and p % 50 = 0, 0.001D, 0.0D) as v"
    )
    return grid.axis_regularity(coords, key="source_no", position="p", value="v")
