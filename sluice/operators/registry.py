"""Schema registry kept as a table (SRC-3/4/6, SNK-4/5, PRD-3/4/5, AGG-6/7, PRJ-13).

The registry is a change log ``(seq, op, name, version, schema)`` with
``op`` in ``set``/``del``.  Its state is the last op per key, kept when that op
is a ``set`` (last writer wins; a delete removes).  Keys use the *normalised*
version, so ``1`` and ``1.0.0`` address the same entry.

Request logs (``add``/``get``/``del`` with an outcome per request) are
answered with the same fold: the state a request sees is the last
state-changing op before it, computed with the skew-safe ``last_before``.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.routes import (DEFAULT_REGISTRY_BASE, URI_SEGMENT, URI_TAIL, normalise_uri,
                                uri_name, uri_version)
from ..functions.semver import DEFAULT_KEY_PREFIX, parse_semver, registry_key, semver_text
from ..session import fs_exists
from .nodes import with_admission
from .sequence import last_before, numbered

def corpus_dir() -> str:
    """Folder of the bundled schema documents."""
    return str(resources.files("sluice") / "schemas")


def load_corpus(spark: SparkSession, path: str | None = None, base: str | None = None) -> DataFrame:
    """One row per ``*.json`` file: ``(path, schemaURI, name, version, schema)``.

    ``schemaURI``/``name``/``version`` come from the document's ``$id``, which
    may be relative to ``base``; they are NULL for a document that does not
    parse or has no usable ``$id`` (the load-error row replaces an exception).
    """
    if path is None:
        # The bundled corpus lives inside the package on the driver only; it is
        # nine small fixed documents, so it is handed to Spark as rows.
        folder = resources.files("sluice") / "schemas"
        docs = sorted((f"file://{folder / n.name}", (folder / n.name).read_text())
                      for n in folder.iterdir() if n.name.endswith(".json"))
        return corpus_from_texts(spark, docs, base)
    raw = (spark.read.option("pathGlobFilter", "*.json")
           .text(path, wholetext=True)
           .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("schema")))
    return _with_ids(raw, base)


def _with_ids(raw: DataFrame, base: str | None = None) -> DataFrame:
    """``(path, schema)`` -> corpus columns; URI, name and version from ``$id``."""
    sid = F.get_json_object("schema", "$['$id']")
    if base is not None:
        sid = F.when(sid.contains("://"), sid).otherwise(
            F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(sid, "^/+", "")))
    return raw.select("path", sid.alias("schemaURI"), uri_name(sid).alias("name"),
                      uri_version(sid).alias("version"), "schema")


# -- admission ---------------------------------------------------------

def request_ok(name: Column | str, version: Column | str) -> Column:
    """Request key check (PRD-4): name present and version parses."""
    n = F.col(name) if isinstance(name, str) else name
    ver = F.col(version) if isinstance(version, str) else version
    return F.coalesce((n != "") & parse_semver(ver).isNotNull(), F.lit(False))


def reject_documents(corpus: DataFrame) -> DataFrame:
    """Rows of a corpus that bulk registration would refuse (SNK-5)."""
    return _admitted(corpus).where(~F.col("__ok")).drop("__ok")


def _admitted(corpus: DataFrame) -> DataFrame:
    """``corpus`` with ``__ok``: the document is a schema and its key is usable."""
    key_ok = request_ok(F.coalesce("name", F.lit("")), F.coalesce("version", F.lit("")))
    return with_admission(corpus, "schema", "__ok").withColumn("__ok", F.col("__ok") & key_ok)


# -- change log --------------------------------------------------------

def canonical_uri(name: Column, version: Column, base: str | Column = DEFAULT_REGISTRY_BASE) -> Column:
    """URI of a registry entry from its base, name and parsed version struct."""
    head = F.lit(base) if isinstance(base, str) else base
    return F.concat(head, F.lit(URI_SEGMENT), name, F.lit("/"), semver_text(version))


def corpus_to_log(corpus: DataFrame) -> DataFrame:
    """Bulk registration (SNK-5) as a change log of ``set`` ops, in path order.

    Each op carries the base of the document's own ``$id``.  Documents are numbered
    within range partitions, so no task sorts the corpus."""
    docs = corpus.select("path", "name", "version", "schema", F.regexp_replace("schemaURI", URI_TAIL, "").alias("base"))
    return numbered(docs, ["path", "schema"], "seq").select("seq", F.lit("set").alias("op"), "name", "version", "schema", "base")


def fold_log(log: DataFrame, prefix: str = DEFAULT_KEY_PREFIX,
             base: str = DEFAULT_REGISTRY_BASE) -> DataFrame:
    """Registry state from a change log (AGG-6).

    Input ``(seq, op, name, version text, schema)`` and optionally ``base``, the
    URI before ``/schemas/`` (null: ``base`` of the call); ops with a bad key
    are ignored (they would be refused).  Output one row per live key:
    ``key, name, version struct, schemaURI, schema``.  ``max_by`` is a partial
    aggregate, so a hot key is combined map-side before the shuffle.
    """
    ver = parse_semver("version")
    own = F.coalesce(F.col("base"), F.lit(base)) if "base" in log.columns else F.lit(base)
    keyed = (log.where(request_ok("name", "version"))
             .withColumn("v", ver).withColumn("base", own)
             .withColumn("key", registry_key("name", F.col("v"), prefix)))
    last = (keyed.groupBy("key")
            .agg(F.max_by(F.struct("op", "name", "v", "schema", "base"), "seq").alias("s")))
    return (last.where(F.col("s.op") == "set")
            .select("key", F.col("s.name").alias("name"), F.col("s.v").alias("version"),
                    canonical_uri(F.col("s.name"), F.col("s.v"), F.col("s.base")).alias("schemaURI"),
                    F.col("s.schema").alias("schema")))


class RegistrationError(ValueError):
    """A corpus document was refused; nothing was registered."""


def register_corpus(spark: SparkSession, path: str | None = None, base: str | None = None,
                    log: str | None = None) -> DataFrame:
    """Bulk registration (SNK-5): refuse the whole corpus if any document is
    refused, naming the first one in path order; otherwise the registry state.

    The corpus is one row per document, so the refusal list is small.  With
    ``log`` the ``set`` ops are appended to that change-log table and the state
    is that of the whole log.
    """
    corpus = load_corpus(spark, path, base)
    first = reject_documents(corpus).orderBy("path").select("path").first()
    if first is not None:
        raise RegistrationError(f"schema document refused: {first['path']}")
    if log is None:
        return fold_log(corpus_to_log(corpus))
    append_log(spark, log, corpus_to_log(corpus))
    return fold_log(read_log(spark, log))


# -- durable change log --------------------------------------------------

LOG_SCHEMA = "seq bigint, op string, name string, version string, schema string, base string"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The change log kept at ``path`` (empty when nothing was ever appended)."""
    if not fs_exists(spark, path):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def append_log(spark: SparkSession, path: str, ops: DataFrame) -> None:
    """Append ops ``(seq, op, name, version, schema[, base])``, numbered after
    all ops the log holds.  One writer at a time, as for any appended table."""
    last = read_log(spark, path).agg(F.max("seq")).first()[0]
    if "base" not in ops.columns:
        ops = ops.withColumn("base", F.lit(None).cast("string"))
    shifted = F.col("seq") + F.lit(0 if last is None else last + 1) - F.lit(_first_seq(ops))
    ops.select(shifted.cast("bigint").alias("seq"), "op", "name", "version", "schema", "base").write.mode("append").parquet(path)


def _first_seq(ops: DataFrame) -> int:
    return ops.agg(F.coalesce(F.min("seq"), F.lit(0))).first()[0]


def delete_entry(spark: SparkSession, path: str, name: str, version: str) -> bool:
    """Append a ``del`` op; False (and nothing appended) when there is no such entry."""
    if lookup(fold_log(read_log(spark, path)), name, version).isEmpty():
        return False
    append_log(spark, path, spark.createDataFrame([(0, "del", name, version, None)],
                                                  "seq bigint, op string, name string, version string, schema string"))
    return True


def registry_of(corpus: DataFrame) -> DataFrame:
    """Registry state after registering every admissible document of a corpus frame."""
    return fold_log(corpus_to_log(_admitted(corpus).where("__ok").drop("__ok")))


def corpus_from_texts(spark: SparkSession, docs: list[tuple[str, str]], base: str | None = None) -> DataFrame:
    """Corpus frame from ``(path, text)`` pairs held on the driver (small, fixed sets)."""
    return _with_ids(spark.createDataFrame(docs, "path string, schema string"), base)


def registry_from_corpus(spark: SparkSession, path: str | None = None, base: str | None = None) -> DataFrame:
    """Registry state after registering every admissible corpus document."""
    return registry_of(load_corpus(spark, path, base))


# -- requests ----------------------------------------------------------

def answer_requests(requests: DataFrame, prefix: str = DEFAULT_KEY_PREFIX,
                    bucket_width: int = 1 << 16) -> DataFrame:
    """Outcome per request (SNK-4, SRC-4, AGG-7, PRD-4/5, PRD-3).

    Input ``(seq BIGINT, op STRING in add/get/del, name, version, schema)``.
    Outcomes: add → ``created`` | ``bad_request``; get → ``ok`` | ``not_found``
    | ``bad_request``; del → ``deleted`` | ``not_found`` | ``bad_request``.
    ``body`` is the registry reply body ``{"schema": …}`` of a successful get.
    """
    ver = parse_semver("version")
    key_ok = request_ok("name", "version")
    # only what an add brings is walked
    good_add = F.col("_good_add")
    r = with_admission(requests.withColumn("_text", F.when((F.col("op") == "add") & key_ok, F.col("schema"))), "_text", "_good_add").drop("_text")
    r = (r
         .withColumn("key", F.when(key_ok, registry_key("name", ver, prefix)))
         .withColumn("_good", F.when(key_ok, F.lit(True)).otherwise(F.lit(False)))
         # state-changing ops: admitted adds and any delete of a valid key
         .withColumn("_change", F.when(good_add, F.struct(F.lit("set").alias("op"), F.col("schema").alias("schema")))
                     .when((F.col("op") == "del") & key_ok, F.struct(F.lit("del").alias("op"), F.lit(None).cast("string").alias("schema")))))
    r = last_before(r, ["key"], "seq", "_change", "_prev", bucket_width)
    live = F.col("_prev.op") == "set"
    outcome = (F.when(~F.col("_good") | ((F.col("op") == "add") & ~good_add), "bad_request")
               .when(F.col("op") == "add", "created")
               .when((F.col("op") == "get") & live, "ok")
               .when((F.col("op") == "del") & live, "deleted")
               .when(F.col("op").isin("get", "del"), "not_found")
               .otherwise("bad_request"))
    body = F.when((F.col("op") == "get") & live,
                  F.concat(F.lit('{"schema":'), F.col("_prev.schema"), F.lit("}")))
    return r.select("seq", "op", "name", "version", "key", outcome.alias("outcome"), body.alias("body"))


def unwrap_body(body: Column | str) -> Column:
    """``{"schema": doc}`` → doc as JSON text, key order kept (PRJ-13)."""
    b = F.col(body) if isinstance(body, str) else body
    return F.get_json_object(b, "$.schema")


def lookup(registry: DataFrame, name: str, version: str) -> DataFrame:
    """Point read (SRC-4): the entry for ``name`` and version text, if any."""
    spark = registry.sparkSession
    probe = spark.range(1).select(F.lit(name).alias("name"), parse_semver(F.lit(version)).alias("version"))
    return registry.join(probe, ["name", "version"], "left_semi")
