"""Activity and accounts as a pair of bucketed tables, so that repeated account joins shuffle neither.

Both tables are bucketed and sorted by (key, salt).  A key with more than ``hot_rows`` activity rows gets
several salts, dealt by a hash of the whole row, and its account rows are repeated once per salt: a hot key
lies in many buckets and no task reads all of it.  Jobs that take ``on=`` join on both columns.  The hot keys
come from a frequent-items sketch over the key column alone; it only routes, so estimates lose nothing.

``write_pair`` registers external tables in the session's catalog.  ``register_pair`` names them again in any
later session, from the description written beside the files, so they do not depend on one catalog's life.

Defined cases: activity without a key joins nothing and is spread over ``NULL_SALTS`` salts; accounts without
a key are kept with salt 0; empty tables give empty tables; an input column named ``_salt`` is an error.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leadscope.operators.skew import DEFAULT_HOT_ROWS, MOST_HOT_KEYS, NULL_SALTS, TRACKED

SALT = "_salt"
DEFAULT_BUCKETS = 2_048
TABLES = ("activity", "account")


def _hot_keys(activity: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """(_hot_key, _salts) of the keys with more than ``hot_rows`` rows, at most ``MOST_HOT_KEYS``."""
    top = activity.agg(F.expr(f"approx_top_k(`{key}`, {MOST_HOT_KEYS}, {TRACKED})").alias("top")).first()["top"] or []
    found = [(t["item"], -(-t["count"] // hot_rows)) for t in top if t["item"] is not None and t["count"] > hot_rows]
    kind = activity.schema[key].dataType.simpleString()
    return F.broadcast(activity.sparkSession.createDataFrame(found, f"_hot_key {kind}, _salts int"))


def _save(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    # one file a bucket: the shuffle deals rows as the bucketed write does
    (df.repartition(buckets, key, SALT).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, key, SALT).sortBy(key, SALT).saveAsTable(name))


def write_pair(activity: DataFrame, account: DataFrame, path: str, prefix: str, key: str = "account_key",
               buckets: int = DEFAULT_BUCKETS, hot_rows: int = DEFAULT_HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Write both tables below ``path``, register them as ``<prefix>_activity`` and ``<prefix>_account`` and
    return them; each has the column ``_salt`` beside its own."""
    if SALT in (*activity.columns, *account.columns):
        raise ValueError(f"a column is named {SALT}")
    if activity.schema[key].dataType != account.schema[key].dataType:
        raise ValueError(f"{key} has two types: such tables would not share their buckets")
    spark, hot = activity.sparkSession, _hot_keys(activity, key, hot_rows)
    salts = F.when(F.col(key).isNull(), F.lit(NULL_SALTS)).otherwise(F.coalesce("_salts", F.lit(1)))
    rows = (activity.join(hot, activity[key] == hot["_hot_key"], "left")
            .withColumn(SALT, F.pmod(F.xxhash64(*activity.columns), salts).cast("int")).select(*activity.columns, SALT))
    lookup = (account.join(hot, account[key] == hot["_hot_key"], "left")
              .withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
              .select(*account.columns, SALT))
    described = []
    for name, df in zip(TABLES, (rows, lookup)):
        _save(df, f"{prefix}_{name}", f"{path}/{name}", key, buckets)
        described.append((name, df.schema.json(), key, buckets))
    (spark.createDataFrame(described, "name string, schema string, key string, buckets int").repartition(1)
     .write.mode("overwrite").json(f"{path}/description"))
    return spark.table(f"{prefix}_activity"), spark.table(f"{prefix}_account")


def register_pair(spark: SparkSession, path: str, prefix: str) -> tuple[DataFrame, DataFrame]:
    """Name the tables written below ``path`` in this session's catalog (names in use are an error)."""
    out = {}
    for r in spark.read.schema("name string, schema string, key string, buckets int").json(f"{path}/description").collect():
        columns = StructType.fromJson(json.loads(r["schema"])).toDDL()
        location = f"{path}/{r['name']}".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE `{prefix}_{r['name']}` ({columns}) USING parquet CLUSTERED BY (`{r['key']}`, `{SALT}`) "
                  f"SORTED BY (`{r['key']}`, `{SALT}`) INTO {r['buckets']} BUCKETS LOCATION '{location}'")
        out[r["name"]] = spark.table(f"{prefix}_{r['name']}")
    return tuple(out[name] for name in TABLES)
