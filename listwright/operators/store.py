"""The keyed listing store: preparing rows, merging batches, stored queries.

A merge is one shuffle join of the target with a batch reduced to one row per
key.  :class:`ListingStore` keeps the table as Parquet in partitions by the
key's hash and rewrites only those that a batch touches; with a MERGE-capable
catalog use :func:`merge_into`.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listwright.functions.dates import parse_stored
from listwright.operators.curate import first_per_key
from listwright.schemas import STORED, conform
from listwright.session import cut_lineage

# --- fixed values: column lists ---------------------------------------------------
KEY = "listing_id"
NOT_NULL = ("listing_id", "title", "listing_url", "scraped_at")
STAMPS = ("created_at", "updated_at")

# columns a batch overwrites in an existing row, per merge flavour
NARROW_UPDATE = ("price_numeric", "description", "criteria", "image_urls", "scraped_at")
SCHEDULED_UPDATE = ("price_numeric", "description", "scraped_at")
SCHEDULED_COLUMNS = (
    "listing_id", "title", "price_numeric", "currency", "category", "city", "governorate",
    "description", "date_posted", "listing_url", "scraped_at",
)


# --- preparing -------------------------------------------------------------------


def store_prepare(df: DataFrame, scope: str | None = None) -> DataFrame:
    """Listings as stored rows: typed, with gaps filled from the criteria.

    ``scope`` is a further key column to be kept, such as the source.
    """
    have = set(df.columns)
    criteria = F.col("criteria") if "criteria" in have else F.lit(None).cast("map<string,string>")

    def column(name: str, kind: str) -> Column:
        return (F.col(name) if name in have else F.lit(None)).cast(kind)

    def from_criteria(key: str) -> Column:
        return F.try_element_at(criteria, F.lit(key))

    def filled(name: str) -> Column:
        # zero counts as missing, as NULL does
        return F.coalesce(F.nullif(column(name, "double"), F.lit(0.0)), from_criteria(name).try_cast("double"))

    columns = {f.name: column(f.name, "string") for f in STORED.fields if f.dataType.simpleString() == "string"}
    columns |= {
        "price_numeric": column("price_numeric", "double").try_cast("decimal(15,2)"),
        "currency": F.col("currency") if "currency" in have else F.lit("TND"),
        "surface": filled("surface").try_cast("decimal(10,2)"),
        **{k: filled(k).try_cast("int") for k in ("rooms", "bedrooms", "bathrooms")},
        "floor": from_criteria("floor").try_cast("double").try_cast("int"),
        "furnished": from_criteria("furnished").try_cast("boolean"),
        "criteria": F.coalesce(criteria, F.create_map().cast("map<string,string>")),
        "image_urls": F.coalesce(column("image_urls", "array<string>"), F.array().cast("array<string>")),
        "image_count": F.coalesce(column("image_count", "int"), F.lit(0)),
        "date_posted": parse_stored(column("date_posted", "string")),
        "scraped_at": column("scraped_at", "timestamp"),
    }
    order = [F.col(c) for c in ("seq", scope) if c in have]
    stored = [f.name for f in STORED.fields if f.name not in STAMPS]
    return df.select(*order, *(columns[c].alias(c) for c in stored))


def _complete() -> Column:
    condition = F.col(NOT_NULL[0]).isNotNull()
    for name in NOT_NULL[1:]:
        condition = condition & F.col(name).isNotNull()
    return condition


def split_valid(prepared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that satisfy NOT NULL, rejected rows with the violated columns)."""
    reason = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in NOT_NULL)))
    return prepared.where(_complete()), prepared.where(~_complete()).withColumn("violations", F.array_join(reason, ","))


def assert_valid(prepared: DataFrame) -> DataFrame:
    """The batch itself, or an error at run time if one row violates NOT NULL."""
    failed = F.raise_error(F.concat(F.lit("NOT NULL violated by listing "), F.coalesce(F.col(KEY), F.lit("NULL"))))
    guarded = F.when(_complete(), F.col(KEY)).otherwise(failed.cast("string"))
    return prepared.withColumn(KEY, guarded)


# --- merging ---------------------------------------------------------------------


def _one_row_per_key(batch: DataFrame, update: tuple[str, ...], order: str, keys: list[str]) -> DataFrame:
    """Batch reduced per key: updated columns from the last row, others from the first.

    This is what applying the rows one by one in ``order`` leaves behind.  The
    aggregate combines map-side, so a key repeated in a third of the batch
    shuffles one row per task.
    """
    rest = [c for c in batch.columns if c not in (*keys, order, *update)]
    picked = [F.max_by(F.struct(*update), order).alias("_last")]
    if rest:
        picked.append(F.min_by(F.struct(*rest), order).alias("_first"))
    reduced = batch.groupBy(*keys).agg(*picked)
    return reduced.select(*keys, "_last.*", *(["_first.*"] if rest else []))


def merge(
    target: DataFrame,
    batch: DataFrame,
    update: tuple[str, ...] | None,
    as_of: Column,
    order: str = "seq",
    touch: bool = True,
    key: str | list[str] = KEY,
) -> DataFrame:
    """Upsert a prepared batch into the target; returns the new table.

    ``key`` may be several columns, such as source and listing id.
    ``update`` lists the columns overwritten in existing rows (None: all).
    Existing rows keep ``created_at`` and get ``updated_at = as_of`` (unless
    ``touch`` is off); new rows get both.
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = [c for c in target.columns if c not in STAMPS]
    batch = batch.select(order, *(c for c in columns if c in batch.columns))
    update = tuple(c for c in (update or columns) if c not in keys and c in batch.columns)
    source = _one_row_per_key(batch, update, order, keys)
    t, s = target.alias("t"), source.withColumn("_hit", F.lit(True)).alias("s")
    joined = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full_outer")
    hit = F.col("s._hit").isNotNull()
    old = F.col(f"t.{keys[-1]}").isNotNull()

    def merged(name: str) -> Column:
        if name in keys:
            return F.coalesce(F.col(f"t.{name}"), F.col(f"s.{name}"))
        if name not in source.columns:
            return F.col(f"t.{name}")
        new = F.col(f"s.{name}")
        if name in update:
            return F.when(hit, new).otherwise(F.col(f"t.{name}"))
        return F.when(old, F.col(f"t.{name}")).otherwise(new)

    stamped = []
    if "created_at" in target.columns:
        stamped.append(F.when(old, F.col("t.created_at")).otherwise(as_of).alias("created_at"))
    if "updated_at" in target.columns:
        stays = old if not touch else ~hit
        stamped.append(F.when(stays, F.col("t.updated_at")).otherwise(as_of).alias("updated_at"))
    return joined.select(*(merged(c).alias(c) for c in columns), *stamped)


def merge_narrow(target: DataFrame, batch: DataFrame, as_of: Column, order: str = "seq", key: str | list[str] = KEY) -> DataFrame:
    """Existing rows take price, text, criteria, images and scrape time only."""
    return merge(target, batch, NARROW_UPDATE, as_of, order, key=key)


def merge_full(target: DataFrame, batch: DataFrame, as_of: Column, order: str = "seq", key: str | list[str] = KEY) -> DataFrame:
    """Existing rows take every prepared column."""
    return merge(target, batch, None, as_of, order, key=key)


def merge_scheduled(target: DataFrame, batch: DataFrame, as_of: Column, order: str = "seq", key: str | list[str] = KEY) -> DataFrame:
    """Daily load: 11 columns inserted, 3 updated; incomplete rows are skipped.

    An update leaves ``updated_at`` as it is.
    """
    keys = [key] if isinstance(key, str) else list(key)
    valid, _ = split_valid(batch.select(order, *dict.fromkeys((*keys, *SCHEDULED_COLUMNS))))
    return merge(target, valid, SCHEDULED_UPDATE, as_of, order, touch=False, key=keys)


def insert_new(target: DataFrame, batch: DataFrame, as_of: Column, order: str = "seq", key: str | list[str] = KEY) -> DataFrame:
    """Add only rows with new keys, the first of each key."""
    keys = [key] if isinstance(key, str) else list(key)
    fresh = first_per_key(batch, keys, order).join(target.select(*keys), keys, "left_anti")
    stamped = fresh.withColumns({name: as_of for name in STAMPS if name in target.columns})
    return target.unionByName(stamped.drop(order).select(*target.columns))


def new_table(prepared: DataFrame, as_of: Column, order: str = "seq", key: str | list[str] = KEY) -> DataFrame:
    """First version of a store: the prepared rows, one per key, stamped."""
    return first_per_key(prepared, key, order).drop(order).withColumns({name: as_of for name in STAMPS})


def merge_into(batch: DataFrame, table: str, update: tuple[str, ...] | None, as_of: Column, order: str = "seq") -> None:
    """The same upsert as MERGE INTO, for catalogs that support it."""
    columns = [c for c in batch.columns if c not in (KEY, order)]
    update = tuple(c for c in (update or columns) if c != KEY)
    source = _one_row_per_key(batch, update, order, [KEY]).withColumns({name: as_of for name in STAMPS}).alias("s")
    set_columns = {c: F.col(f"s.{c}") for c in (*update, "updated_at")}
    (
        source.mergeInto(table, F.col(f"{table}.{KEY}") == F.col(f"s.{KEY}"))
        .whenMatched().update(set_columns)
        .whenNotMatched().insertAll()
        .merge()
    )


# --- stored queries --------------------------------------------------------------


def by_id(table: DataFrame, listing_id: str) -> DataFrame:
    return table.where(F.col(KEY) == listing_id)


def by_city(table: DataFrame, city: str) -> DataFrame:
    return table.where(F.col("city") == city)


def recent(table: DataFrame, n: int = 100) -> DataFrame:
    """Latest scraped rows; listing_id breaks ties."""
    return table.orderBy(F.desc("scraped_at"), KEY).limit(n)


def count_by_category(table: DataFrame) -> DataFrame:
    return table.groupBy("category").agg(F.count(F.lit(1)).alias("listings"))


def top_cities(table: DataFrame, n: int = 10) -> DataFrame:
    """Most frequent cities; here a NULL city counts, ties go by name."""
    return table.groupBy("city").agg(F.count(F.lit(1)).alias("listings")).orderBy(F.desc("listings"), "city").limit(n)


def totals(table: DataFrame) -> DataFrame:
    """Row count, average price and latest scrape."""
    return table.agg(
        F.count(F.lit(1)).alias("total_listings"),
        F.avg(F.col("price_numeric").cast("decimal(15,2)")).cast("double").alias("avg_price"),
        F.max("scraped_at").alias("latest_scrape"),
    )


# --- the stored table --------------------------------------------------------------


class ConcurrentWrite(RuntimeError):
    """Another writer committed first; the batch may be tried again."""


@dataclass
class _Manifest:
    """One version of the table: which folder holds each partition, and the runs that made it."""

    version: int = 0
    partitions: int = 0
    scopes: list = field(default_factory=list)  # values of the scope column, by number
    parts: list = field(default_factory=list)  # [number of the scope, partition, folder]
    runs: dict = field(default_factory=dict)  # run id -> what it reported


@dataclass
class ListingStore:
    """A keyed table in Parquet files, with versions.

    Rows lie in ``partitions`` folders by the hash of their listing id, below
    one folder a value of ``scope`` (a further key column such as the source,
    if given).  A version is a small manifest file that names the folder of
    each partition.  A merge reads and rewrites only the partitions its batch
    has keys of; all others are carried over by name.  Manifests are put in
    place without replacing one that is there, so of two writers that start
    from the same version the second one fails with :class:`ConcurrentWrite`
    and changes nothing.  Old versions stay readable until :meth:`vacuum`.

    ``name`` is a path, or a plain name: then the table is below the warehouse
    folder and a view of that name shows what this session committed last.
    """

    spark: SparkSession
    name: str
    partitions: int = 64
    scope: str | None = None

    @property
    def path(self) -> str:
        base = self.name if "/" in self.name else f"{self.spark.conf.get('spark.sql.warehouse.dir')}/{self.name}.store"
        return base.rstrip("/")

    @property
    def keys(self) -> list[str]:
        return [self.scope, KEY] if self.scope else [KEY]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([*([T.StructField(self.scope, T.StringType())] if self.scope else []), *STORED.fields])

    # files of the shared file system, whatever it is

    def _at(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        return self._at(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        where = self._at(f"{self.path}/{folder}")
        return [status.getPath().getName() for status in self._files().listStatus(where)] if self._files().exists(where) else []

    def _put(self, target: str, text: str) -> None:
        """Write a small file under a new name; fails if the name is taken."""
        jvm, draft = self.spark._jvm, f"{self.path}/_drafts/{uuid.uuid4().hex}"
        out = self._files().create(self._at(draft), False)
        out.write(bytearray(text.encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files().getUri(), self.spark._jsc.hadoopConfiguration())
        nothing_replaced = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        qualified = lambda p: self._files().makeQualified(self._at(p))
        self._files().mkdirs(self._at(target).getParent())
        try:
            context.rename(qualified(draft), qualified(target), nothing_replaced)
        except Py4JJavaError as error:
            self._files().delete(self._at(draft), False)
            if "FileAlreadyExists" in str(error.java_exception):
                raise ConcurrentWrite(f"{target} is there already") from None
            raise

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._names("_manifests") if n.endswith(".json"))

    def _manifest(self, version: int | None = None) -> _Manifest:
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return _Manifest(partitions=self.partitions)
        text = self.spark.read.text(f"{self.path}/_manifests/{version:012d}.json", wholetext=True).first()[0]
        return _Manifest(**json.loads(text))

    def _read(self, parts: list) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{folder}/_s={s}/_p={p}" for s, p, folder in parts))

    def _placed(self, df: DataFrame, partitions: int, scopes: list) -> DataFrame:
        """Adds the numbers of the scope and the partition."""
        numbers = F.create_map(*(F.lit(x) for i, value in enumerate(scopes) if value is not None for x in (value, i))) if any(v is not None for v in scopes) else None
        scope = F.lit(0) if numbers is None or not self.scope else F.coalesce(F.try_element_at(numbers, F.col(self.scope)), F.lit(-1))
        return df.withColumns({"_s": scope, "_p": F.pmod(F.xxhash64(KEY), F.lit(partitions)).cast("int")})

    def _commit(self, base: _Manifest, rows: DataFrame, scopes: list, replaced: set | None, run: tuple[str, dict] | None) -> int:
        """Write rows as new partitions and the next manifest; ``replaced`` are the partitions they stand for (None: all)."""
        folder = f"data/{base.version + 1:012d}-{uuid.uuid4().hex}"
        placed = self._placed(conform(rows, self.schema), base.partitions, scopes)
        placed.hint("rebalance", "_s", "_p").write.partitionBy("_s", "_p").parquet(f"{self.path}/{folder}")
        written = [(int(s.removeprefix("_s=")), int(p.removeprefix("_p="))) for s in self._names(folder) if s.startswith("_s=") for p in self._names(f"{folder}/{s}")]
        kept = [part for part in base.parts if replaced is not None and (part[0], part[1]) not in replaced]
        runs = {**base.runs, run[0]: run[1]} if run else base.runs
        made = _Manifest(base.version + 1, base.partitions, scopes, sorted([*kept, *([s, p, folder] for s, p in written)]), runs)
        self._put(f"{self.path}/_manifests/{made.version:012d}.json", json.dumps(made.__dict__))
        if "/" not in self.name:
            self.table().createOrReplaceTempView(self.name)
        return made.version

    def runs(self) -> dict[str, dict]:
        """What the committed runs reported, by their ids."""
        return self._manifest().runs

    def exists(self) -> bool:
        return bool(self.versions())

    def create(self) -> "ListingStore":
        """Create the empty store unless it exists."""
        if not self.exists():
            self.write(self.spark.createDataFrame([], self.schema))
        return self

    def table(self, scope: str | None = None, version: int | None = None) -> DataFrame:
        """The newest or an older version; of one scope, only its files are read."""
        manifest = self._manifest(version)
        wanted = manifest.parts if scope is None else [p for p in manifest.parts if scope in manifest.scopes and p[0] == manifest.scopes.index(scope)]
        return self._read(wanted) if scope is None else self._read(wanted).where(F.col(self.scope) == scope)

    def lookup(self, listing_id: str, scope: str | None = None) -> DataFrame:
        """Rows of one listing id; only its partition is read."""
        manifest = self._manifest()
        p = self.spark.range(1).select(F.pmod(F.xxhash64(F.lit(listing_id)), F.lit(manifest.partitions)).cast("int")).first()[0]
        wanted = [part for part in manifest.parts if part[1] == p and (scope is None or manifest.scopes[part[0]] == scope)]
        found = self._read(wanted).where(F.col(KEY) == listing_id)
        return found if scope is None else found.where(F.col(self.scope) == scope)

    def _scopes(self, manifest: _Manifest, rows: DataFrame) -> list:
        """The scopes known and those of the rows: one for each source, few."""
        if not self.scope:
            return manifest.scopes or [None]
        new = {r[0] for r in rows.select(self.scope).distinct().collect()} - set(manifest.scopes)
        return [*manifest.scopes, *sorted(new, key=str)]

    def write(self, df: DataFrame) -> int:
        """Replace the whole table by ``df``."""
        base = self._manifest()
        base.partitions = base.partitions or self.partitions
        rows = cut_lineage(conform(df, self.schema))
        return self._commit(base, rows, self._scopes(base, rows), None, None)

    def upsert(self, listings: DataFrame, as_of: Column, flavour: str = "narrow", run: tuple[str, dict] | None = None) -> int:
        """Prepare, check and merge listings: narrow, full, scheduled or insert; returns the version.

        ``run`` is an id with what the run reports.  It is committed with the
        rows, and a run that was committed before changes nothing.  A report
        may have an ``epoch``: then the id stands for a stream, and only later
        epochs than the recorded one change something.
        """
        merges = {"narrow": merge_narrow, "full": merge_full, "scheduled": merge_scheduled, "insert": insert_new}
        base = self.create()._manifest()
        if run and run[0] in base.runs and base.runs[run[0]].get("epoch", 0) >= run[1].get("epoch", 0):
            return base.version
        prepared = store_prepare(listings, self.scope)
        checked = split_valid(prepared)[0] if flavour == "scheduled" else assert_valid(prepared)
        batch = cut_lineage(checked)
        scopes = self._scopes(base, batch)
        hit = {(r["_s"], r["_p"]) for r in self._placed(batch, base.partitions, scopes).select("_s", "_p").distinct().collect()}
        target = self._read([part for part in base.parts if (part[0], part[1]) in hit])
        return self._commit(base, merges[flavour](target, batch, as_of, key=self.keys), scopes, hit, run)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Forget all but the newest ``keep`` versions and delete the folders none of them names; returns these.

        Call it when no reader uses an older version and no writer is at work.
        """
        versions = self.versions()
        used = {part[2] for v in versions[-keep:] for part in self._manifest(v).parts}
        for v in versions[:-keep]:
            self._files().delete(self._at(f"{self.path}/_manifests/{v:012d}.json"), False)
        unused = [f"data/{name}" for name in self._names("data") if f"data/{name}" not in used]
        for folder in unused:
            self._files().delete(self._at(f"{self.path}/{folder}"), True)
        return unused


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    """Store rows in a database; maps and arrays go as JSON text.

    Needs the database's JDBC driver on the class path.
    """
    rows = df.withColumns({"criteria": F.to_json("criteria"), "image_urls": F.to_json("image_urls")})
    rows.write.format("jdbc").options(url=url, dbtable=table, **options).mode(mode).save()
