"""S6/O29 incrementally: an attribution table that is refreshed by the users a load touches.

Later events rewrite earlier rows (a login merges visitors, an order closes a
cycle, a registration may become the first), but only for certain users.  A
refresh therefore recomputes whole users, and only those:

* every visitor with new rows, under the user it belonged to before the load and
  the one it belongs to now (so a login that moves it touches both), with all
  visitors blended with them;
* every user with a session id under which one of those converts, because
  conversions roll up by session id alone (not with ``session_key="user_session"``).

Recomputing them takes all session starts of these users, and all conversions of
every user who converts under one of their session ids.

State is the narrow table of role rows (``operators.roles``), one folder a load, and
the result, bucketed by a hash of the user.  A refresh writes the touched buckets
to a new version folder and then publishes a manifest that names the version of
every bucket; readers see the old table or the new one.  A refresh that failed is
run again under the same number and replaces what it had written.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_CONFIG, AttributionConfig
from ..functions.columns import non_null_key
from ..operators import identity, roles
from . import chunked as ck
from .pipeline import Attribution

BUCKET = "bucket"
USER = "_user"      # non-null key of a blended user
VISITOR = "_visitor"  # non-null key of a pseudo id


@dataclass(frozen=True)
class Refresh:
    """What one refresh did."""

    version: int
    buckets: list[int]  # those written


class AttributionTable:
    """The long-form attribution under ``path``, kept up to date load by load."""

    def __init__(self, spark: SparkSession, path: str, cfg: AttributionConfig = DEFAULT_CONFIG, buckets: int = 256):
        self.spark = spark
        self.path = path.rstrip("/")
        self.cfg = cfg
        self.buckets = buckets

    # ---- manifests

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def manifest(self) -> dict:
        """The latest published state."""
        fs, folder = self._fs(f"{self.path}/_manifests")
        names = sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []
        names = [n for n in names if n.endswith(".json")]
        if not names:
            return {"version": 0, "buckets": {}, "n_buckets": self.buckets, "schema": None, "config": repr(self.cfg)}
        found = json.loads("".join(r[0] for r in self.spark.read.text(f"{self.path}/_manifests/{names[-1]}").collect()))
        if (found["n_buckets"], found["config"]) != (self.buckets, repr(self.cfg)):
            raise ValueError("the table was built with another configuration or number of buckets")
        return found

    def _publish(self, manifest: dict) -> None:
        fs, temporary = self._fs(f"{self.path}/_manifests/{manifest['version']:09d}.tmp")
        _, final = self._fs(f"{self.path}/_manifests/{manifest['version']:09d}.json")
        out = fs.create(temporary, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if not fs.rename(temporary, final):
            raise RuntimeError(f"version {manifest['version']} was published by someone else")

    # ---- reading

    def read(self) -> DataFrame:
        """The result as last published."""
        return self._result(self.manifest()).drop(BUCKET)

    def _result(self, manifest: dict, buckets: list[int] | None = None) -> DataFrame:
        wanted = {b: v for b, v in manifest["buckets"].items() if buckets is None or int(b) in buckets}
        if manifest["schema"] is None:
            raise ValueError("the table has not been refreshed yet")
        schema = T.StructType.fromJson(manifest["schema"])
        with_bucket = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
        if not wanted:
            return self.spark.createDataFrame([], with_bucket)
        # At most one path per bucket, a number that does not grow with the data.
        return self.spark.read.schema(schema).parquet(
            *[f"{self.path}/result/version={v}/{BUCKET}={b}" for b, v in sorted(wanted.items())]
        ).withColumn(BUCKET, self._bucket(non_null_key(F.col("blended_user_id"))))

    def _bucket(self, user):
        return F.pmod(F.xxhash64(user), F.lit(self.buckets)).cast("int")

    def _roles(self, version: int) -> DataFrame:
        paths = [f"{self.path}/roles/load={n}" for n in range(1, version + 1)]
        return self.spark.read.parquet(*paths)

    # ---- refreshing

    def refresh(self, new_rows: DataFrame) -> Refresh:
        """Take in export rows that the table has not seen yet."""
        before = self.manifest()
        version = before["version"] + 1
        roles.role_rows(new_rows, self.cfg).write.mode("overwrite").parquet(f"{self.path}/roles/load={version}")
        known = self._roles(version).withColumn(VISITOR, non_null_key(F.col("user_pseudo_id")))
        users = ck.checkpoint(self._touched(known, version))
        touched = sorted(r[0] for r in users.select(self._bucket(F.col(USER))).distinct().collect())  # <= buckets
        with Attribution(None, self.cfg) as run:
            run.roles = ck.checkpoint(self._needed(known, users))
            result = run.result
            schema = result.schema
            rows = result.withColumn(BUCKET, self._bucket(non_null_key(F.col("blended_user_id"))))
            if before["schema"] is not None:
                old = self._result(before, touched).withColumn(USER, non_null_key(F.col("blended_user_id")))
                rows = rows.unionByName(old.join(users, USER, "left_anti").drop(USER))
            folder = f"{self.path}/result/version={version}"
            rows.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        filled = self._written(folder)
        buckets = {b: v for b, v in before["buckets"].items() if int(b) not in touched}
        buckets.update({str(b): version for b in filled})
        self._publish({"version": version, "buckets": buckets, "n_buckets": self.buckets, "schema": schema.jsonValue(),
                       "config": repr(self.cfg)})
        return Refresh(version, touched)

    def _written(self, folder: str) -> list[int]:
        """The buckets that a version holds rows of."""
        fs, p = self._fs(folder)
        names = [f.getPath().getName() for f in fs.listStatus(p)]
        return [int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}=")]

    def _owners(self, known: DataFrame) -> DataFrame:
        """Every visitor and the user it belongs to, as keys."""
        logins = identity.login_keys(identity.login_map(identity.last_logins(roles.login_rows(known))))
        visitors = known.select(F.col(VISITOR).alias(ck.KEY)).distinct()
        return (visitors.join(logins, ck.KEY, "left")
                .select(F.col(ck.KEY).alias(VISITOR),
                        F.coalesce(F.concat(F.lit("1"), F.col("_login")), F.col(ck.KEY)).alias(USER)))

    def _touched(self, known: DataFrame, version: int) -> DataFrame:
        """Users whose rows the load may change."""
        new = self.spark.read.parquet(f"{self.path}/roles/load={version}").select(non_null_key(F.col("user_pseudo_id")).alias(VISITOR)).distinct()
        now = self._owners(known)
        users = now.join(new, VISITOR, "left_semi").select(USER)
        if version > 1:
            earlier = self._roles(version - 1).withColumn(VISITOR, non_null_key(F.col("user_pseudo_id")))
            users = users.union(self._owners(earlier).join(new, VISITOR, "left_semi").select(USER))
        users = users.distinct()
        if self.cfg.session_key != "session":
            return users
        theirs = now.join(users, USER, "left_semi").select(VISITOR)
        converted = (known.filter(roles.CONVERSION).join(theirs, VISITOR, "left_semi")
                     .filter(F.col("session_id").isNotNull()).select("session_id").distinct())
        sharing = known.filter(roles.START).join(converted, "session_id", "left_semi").select(VISITOR).distinct()
        return users.union(now.join(sharing, VISITOR, "left_semi").select(USER)).distinct()

    def _needed(self, known: DataFrame, users: DataFrame) -> DataFrame:
        """The role rows from which those users are recomputed."""
        now = self._owners(known)
        visitors = now.join(users, USER, "left_semi").select(VISITOR)
        starts = known.filter(roles.START).join(visitors, VISITOR, "left_semi")
        ids = starts.select("session_id").filter(F.col("session_id").isNotNull()).distinct()
        converting = known.filter(roles.CONVERSION).join(ids, "session_id", "left_semi").select(VISITOR).distinct()
        scored = now.join(now.join(converting, VISITOR, "left_semi").select(USER).distinct(), USER, "left_semi")
        scored = scored.select(VISITOR)
        conversions = known.filter(roles.CONVERSION).join(scored, VISITOR, "left_semi")
        logins = known.filter(roles.LOGIN).join(visitors.union(scored).distinct(), VISITOR, "left_semi")

        def only(rows: DataFrame, role: str) -> DataFrame:
            flags = {r: F.lit(r == role) for r in (roles.START, roles.CONVERSION, roles.LOGIN)}
            return rows.withColumns(flags).select(*known.columns)

        parts = (only(starts, roles.START), only(conversions, roles.CONVERSION), only(logins, roles.LOGIN))
        return parts[0].union(parts[1]).union(parts[2]).drop(VISITOR)
