"""Catalogue tables: joins, validation, upserts, caches.

Parquet tables have no MERGE, so an upsert is a rewrite of the key space: the
existing and the incoming rows are unioned and one row per key is chosen with
``max``/``min`` over ordered structs. These combine before the shuffle, so a key
that is repeated very often never becomes one large group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col


def latest_per(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` columns per key."""
    rest = [n for n in df.columns if n not in keys and n not in order]
    newest = F.max(F.struct(*order, *rest)).alias("r")
    return df.groupBy(*keys).agg(newest).select(*keys, *[c(f"r.{n}").alias(n) for n in (*order, *rest)])


def upsert(existing: DataFrame, incoming: DataFrame, *, keys: list[str], version: str, keep_first: list[str]) -> DataFrame:
    """Insert or replace by key; ``keep_first`` columns keep their oldest value.

    ``version`` orders the rows of a key; existing rows carry lower versions.
    """
    both = existing.unionByName(incoming)
    rest = [n for n in both.columns if n not in keys and n not in keep_first and n != version]
    merged = both.groupBy(*keys).agg(
        F.max(F.struct(version, *rest)).alias("new"), F.min(F.struct(version, *keep_first)).alias("old")
    )
    return merged.select(
        *keys,
        *[c(f"old.{n}").alias(n) for n in keep_first],
        c(f"new.{version}").alias(version),
        *[c(f"new.{n}").alias(n) for n in rest],
    )


MIRROR_FIELDS = ("mirror_status", "mirror_path", "mirror_checksum")


def upsert_assets(existing: DataFrame, incoming: DataFrame, *, keys: list[str]) -> DataFrame:
    """Assets by (scene, key): mirror fields and size survive incoming NULLs.

    The mirror status of the existing row is kept exactly where the incoming row
    brings no mirror path and the existing row has one.
    """
    old = existing.select(*keys, *[c(n).alias(f"old_{n}") for n in existing.columns if n not in keys])
    new = incoming.withColumn("incoming", F.lit(True))
    joined = old.join(new, keys, "full_outer")
    fresh = c("incoming").isNotNull()
    kept = fresh & c("mirror_path").isNull() & c("old_mirror_path").isNotNull()
    merged = {
        "href": F.when(fresh, c("href")).otherwise(c("old_href")),
        "size_bytes": F.coalesce("size_bytes", "old_size_bytes"),
        "mirror_status": F.when(fresh & ~kept, c("mirror_status")).otherwise(c("old_mirror_status")),
        "mirror_path": F.coalesce("mirror_path", "old_mirror_path"),
        "mirror_checksum": F.coalesce("mirror_checksum", "old_mirror_checksum"),
    }
    return joined.select(*keys, *[value.alias(name) for name, value in merged.items()])


def create_or_get_jobs(requests: DataFrame) -> DataFrame:
    """Each job request resolved to the one active job of its key.

    The first request of a key creates the job; failed jobs free their key.
    ``requests``: request_id, key_hash, failed.
    """
    active = requests.where(~c("failed")).groupBy("key_hash").agg(F.min("request_id").alias("job_id"))
    return requests.join(active, "key_hash", "left").select(
        "request_id", "key_hash",
        F.coalesce("job_id", "request_id").alias("job_id"),
        (c("failed") | (c("job_id") == c("request_id"))).alias("created"),
    )


def cache_lookup(requests: DataFrame, cached: DataFrame, *, keys: list[str], now: Column) -> DataFrame:
    """Newest unexpired cached result per request, NULL where there is none."""
    live = cached.where(c("expires_at").isNull() | (c("expires_at") > now))
    newest = latest_per(live.select(*keys, "created_at", "query_id"), keys, ["created_at", "query_id"])
    return requests.join(newest, keys, "left")


def purge(cached: DataFrame, *, now: Column) -> DataFrame:
    """The cache without its expired rows; rows without an expiry stay."""
    return cached.where(c("expires_at").isNull() | (c("expires_at") > now))


def default_profile(requests: DataFrame, profiles: DataFrame) -> DataFrame:
    """Default profile per request: the source's own beats the generic one.

    Profiles with a NULL source are generic. Both lookups are equi-joins on a
    dimension that was reduced to one row per key first.
    """
    newest = latest_per(profiles.where("is_default"), ["index_name", "source_no"], ["created_at", "profile_key"])
    own = newest.where("source_no is not null").select("index_name", "source_no", c("profile_key").alias("own_key"))
    generic = newest.where("source_no is null").select("index_name", c("profile_key").alias("generic_key"))
    return (
        requests.join(own, ["index_name", "source_no"], "left")
        .join(generic, "index_name", "left")
        .withColumn("profile_key", F.coalesce("own_key", "generic_key"))
        .drop("own_key", "generic_key")
    )


def complete_scenes(scenes: DataFrame, outputs: DataFrame, required: DataFrame, *, published: Column) -> DataFrame:
    """Scenes that own every required index of their source and are published.

    ``required`` is the index-role dimension; counting distinct matching index
    names keeps the state per scene constant.
    """
    wanted = required.groupBy("source_no").agg(F.count("*").alias("wanted"))
    have = (
        outputs.select("scene_id", "source_no", "index_name").distinct()
        .join(required.select("source_no", "index_name"), ["source_no", "index_name"])
        .groupBy("scene_id", "source_no")
        .agg(F.count("*").alias("have"))
    )
    full = have.join(wanted, "source_no").where("have = wanted").select("scene_id")
    return scenes.where(published).join(full, "scene_id", "left_semi")


def display_assets(assets: DataFrame, *, key: str = "scene_id") -> DataFrame:
    """Which assets show a scene: three mirrored colour bands, else the prepared one."""
    mirrored = (c("mirror_status") == "mirrored") & c("mirror_path").isNotNull()
    rgb = c("asset_key").isin("red", "green", "blue") & mirrored
    prepared = (c("asset_key") == "analytic") & c("asset_kind").isin("analytic", "prepared")
    found = assets.groupBy(key).agg(
        F.max(F.when(rgb & (c("asset_key") == "red"), 1)).alias("r"),
        F.max(F.when(rgb & (c("asset_key") == "green"), 1)).alias("g"),
        F.max(F.when(rgb & (c("asset_key") == "blue"), 1)).alias("b"),
        F.max(F.when(prepared, 1)).alias("p"),
    )
    choice = F.when((c("r") + c("g") + c("b")) == 3, "red,green,blue").when(c("p") == 1, "analytic")
    return found.select(key, choice.alias("display"))


def provenance_ok(composite: Column, acquired: Column, contributors: Column) -> Column:
    """Exact-date composites only: every contributor shares the published date.

    Not a composite, or no contributor detail: accepted. Detail without an
    acquisition date, or a contributor without a readable date: rejected.
    """
    detailed = composite & contributors.isNotNull() & (F.size(contributors) > 0)
    same = F.forall(contributors, lambda d: F.coalesce(d.try_cast("date") == acquired, F.lit(False)))
    return F.when(~F.coalesce(detailed, F.lit(False)), True).when(acquired.isNull(), False).otherwise(same)


def item_problems(required: tuple[str, ...], asset_keys: Column, bands_without_scale: Column) -> Column:
    """Missing required assets and reflectance assets without a scale."""
    missing = F.array_sort(F.array_except(F.array(*[F.lit(k) for k in required]), asset_keys))
    unscaled = F.array_sort(bands_without_scale)
    return F.array_compact(F.array(
        F.when(F.size(missing) > 0, F.concat(F.lit("missing required assets: "), F.array_join(missing, ", "))),
        F.when(F.size(unscaled) > 0, F.concat(F.lit("missing raster scale: "), F.array_join(unscaled, ", "))),
    ))


def integrity(expected_bytes: Column, actual_bytes: Column, header: Column, expected: Column, sha256: Column, md5: Column) -> Column:
    """Outcome of a download check: size first, then the header's checksum.

    Checksums may be hexadecimal or base64; multipart etags are not checksums.
    """
    strong = header.isin("x-checksum-sha256", "x-amz-checksum-sha256")
    etag = header == "etag"
    clean = F.lower(F.trim(F.regexp_replace(expected, '"', "")))
    width = F.when(strong, 64).otherwise(32)
    is_hex = clean.rlike("^[0-9a-f]+$") & (F.length(clean) == width)
    decoded = F.lower(F.hex(F.try_to_binary(F.trim(F.regexp_replace(expected, '"', "")), F.lit("base64"))))
    wanted = F.when(is_hex, clean).when(~etag & (F.length(decoded) == width), decoded)
    actual = F.lower(F.when(strong, sha256).otherwise(md5))
    return (
        F.when(expected_bytes.isNotNull() & (expected_bytes != actual_bytes), "size_mismatch")
        .when(wanted.isNull(), "unchecked")
        .when(wanted != actual, "checksum_mismatch")
        .otherwise("verified")
    )


def complete_dates(dated: DataFrame, required: dict[int, tuple[str, ...]], *, keys: tuple[str, ...] = ("source_no", "aoi_no", "acq_date")) -> DataFrame:
    """Dates on which every index that the row's source requires exists.

    ``required`` is the profile: index names per source, a handful of constants. One pass, one aggregate with
    map-side sets of at most as many names as a source requires.
    """
    wanted = F.create_map(*[x for no, names in required.items() for x in (F.lit(no).cast("long"), F.array(*map(F.lit, names)))])
    needed = F.try_element_at(wanted, c("source_no").cast("long"))
    have = dated.withColumn("needed", needed).where(F.array_contains("needed", c("index_name")))
    counted = have.groupBy(*keys).agg(F.size(F.collect_set("index_name")).alias("have"), F.first(F.size("needed")).alias("needed"))
    return counted.where("have = needed").select(*keys)
