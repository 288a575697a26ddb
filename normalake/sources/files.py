"""Readers: Parquet, JSON lines, CSV index, manifests, spans, HTML, archive listings."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from normalake.functions.identity import join_url, without_scheme
from normalake.operators.captures import identities
from normalake.schema import CAPTURES, VERSIONS
from normalake.sources.tables import _path, stored

SPANS = "text STRING, label ARRAY<STRUCT<category: STRING, start: BIGINT, end: BIGINT>>, info MAP<STRING, STRING>"


def versions_parquet(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def versions_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines under the pinned schema, so that a column of nulls keeps its type."""
    return spark.read.schema(VERSIONS).json(path)


def xml_documents(spark: SparkSession, path: str, ente: str) -> DataFrame:
    """One row a file: lei_id (the file's stem), ente, xml."""
    files = spark.read.option("pathGlobFilter", "*.xml").text(path, wholetext=True)
    return files.select(F.regexp_replace("_metadata.file_name", r"\.xml$", "").alias("lei_id"), F.lit(ente).alias("ente"), F.col("value").alias("xml"))


def checked(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """found (lei_id, ente, content: bytes) -> the sound documents (lei_id,
    ente, xml) and the refused ones (lei_id, reason): ``unread`` (no bytes could
    be had), ``empty``, ``encoding`` (not UTF-8). Sound ones may still fail to
    parse; flatten.walked() says so."""
    text = F.col("content").cast("string")
    reason = F.when(F.col("content").isNull(), "unread").when(F.octet_length("content") == 0, "empty").when(~F.is_valid_utf8(text), "encoding")
    rows = found.select("lei_id", "ente", text.alias("xml"), reason.alias("reason"))
    return rows.where("reason IS NULL").drop("reason"), rows.where("reason IS NOT NULL").select("lei_id", "reason")


def xml_documents_checked(spark: SparkSession, path: str, ente: str) -> tuple[DataFrame, DataFrame]:
    """checked() of the *.xml files of a folder, as bytes (2 GB a file at
    most). A folder without such files is an error. Readers pass over files
    without a byte, so these are taken from the folder's listing."""
    at, fs = _path(spark, f"{path.rstrip('/')}/*.xml")
    listed = fs.globStatus(at) or []
    if not listed:
        raise FileNotFoundError(f"no .xml files in {path}")
    none = [(f.getPath().getName()[:-4], ente, b"") for f in listed if f.getLen() == 0]
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").load(path)
    name = F.regexp_extract(F.url_decode("path"), r"([^/]+)\.xml$", 1)
    found = raw.select(name.alias("lei_id"), F.lit(ente).alias("ente"), "content")
    return checked(found.union(spark.createDataFrame(none, "lei_id string, ente string, content binary")))


def batch_report(sound: DataFrame, refused: DataFrame, unparsed: DataFrame) -> DataFrame:
    """One row: total, converted, refused and unparsed documents, and the exit
    code of the batch: 1 if one could not be read, or none is left, else 0.
    unparsed (lei_id) are those among the sound that gave no rows, one row each:
    documents may share an id."""
    one, zero = F.lit(1), F.lit(0)
    rows = sound.select(one.alias("s"), zero.alias("r"), zero.alias("u")).union(refused.select(zero, one, zero)).union(unparsed.select(zero, zero, one))
    n = rows.agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in "sru"])
    code = F.when((F.col("r") > 0) | (F.col("s") == 0), 1).otherwise(0)
    return n.select((F.col("s") + F.col("r")).alias("total"), (F.col("s") - F.col("u")).alias("converted"), F.col("r").alias("refused"), F.col("u").alias("unparsed"), code.alias("exit_code"))


def capture_index(spark: SparkSession, path: str) -> DataFrame:
    """Columns by name; one that is missing, or empty, is an empty string."""
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    return raw.select(*[(F.coalesce(F.col(c), F.lit("")) if c in raw.columns else F.lit("")).alias(c) for c in CAPTURES.names])


def spans_json(spark: SparkSession, path: str) -> DataFrame:
    """Span records; blank lines are skipped, bad ones end in _corrupt_record."""
    return spark.read.schema(SPANS + ", _corrupt_record STRING").option("mode", "PERMISSIVE").json(path)


def span_splits(spark: SparkSession, folder: str, splits: tuple[str, ...] = ("train", "val", "test")) -> tuple[DataFrame, list[str]]:
    """The records of a folder's splits (split.jsonl each) with their split,
    and the splits that are not there."""
    there, missing = [], []
    for name in splits:
        at, fs = _path(spark, f"{folder.rstrip('/')}/{name}.jsonl")
        (there if fs.exists(at) else missing).append(name)
    found = [spans_json(spark, f"{folder.rstrip('/')}/{name}.jsonl").withColumn("split", F.lit(name)) for name in there]
    none = spark.createDataFrame([], SPANS + ", _corrupt_record STRING, split STRING")
    return reduce(lambda a, b: a.unionByName(b), found, none), missing


def label_space(spark: SparkSession, path: str) -> list[str]:
    """The category names; the background O must come first."""
    row = spark.read.option("multiLine", True).json(path).first()
    names = list(next(v for v in row.asDict().values() if isinstance(v, list)))
    if not names or names[0] != "O":
        raise ValueError("the background O must be first")
    return names


def manifest_probes(spark: SparkSession, path: str) -> DataFrame:
    """fonte, strategy and its options from a nested sources manifest."""
    schema = "ente STRING, fontes MAP<STRING, STRUCT<tipo_ingestion: STRING, discovery: ARRAY<STRUCT<strategy: STRING, url: STRING, prefix: STRING, start: BIGINT, end: BIGINT>>>>"
    m = spark.read.schema(schema).option("multiLine", True).json(path)
    return m.select("ente", F.explode("fontes").alias("fonte", "f")).select("ente", "fonte", "f.tipo_ingestion", F.explode("f.discovery").alias("d")).select("ente", "fonte", "tipo_ingestion", "d.*")


def html_links(pages: DataFrame, base: str, ending: str = r"\.pdf") -> DataFrame:
    """page columns with link: each distinct href, resolved."""
    found = F.regexp_extract_all("html", F.lit(rf"(?i)href=['\"]?([^'\" >]+{ending})['\"]?"), 1)
    return pages.withColumn("link", F.explode(F.array_distinct(found))).drop("html").withColumn("link", join_url(F.col(base), F.col("link")))


def archive_rows(listing: DataFrame) -> DataFrame:
    """listing (timestamp, original, statuscode): PDFs that were there, one
    scheme for the original, and the capture's URL."""
    ok = F.endswith(F.lower("original"), F.lit(".pdf")) & (F.col("statuscode") == "200")
    return listing.where(ok).select(F.concat(F.lit("https://"), without_scheme(F.col("original"))).alias("url"), F.concat(F.lit("https://web.archive.org/web/"), "timestamp", F.lit("/"), "original").alias("snapshot"))


def is_pdf(content: Column) -> Column:
    """Whether the bytes are those of a PDF, by the first four."""
    return F.substring(content, 1, 4) == F.lit(b"%PDF")


def archived_urls(listing: DataFrame) -> DataFrame:
    """listing (original, statuscode): the distinct addresses that were captured,
    as themselves or as a redirection."""
    return listing.where(F.col("statuscode").isin("200", "301", "302")).select(F.col("original").alias("url")).distinct()


def raw_ids(read: list[Callable[[], DataFrame | None]], ente: str, fonte: str, prefix: str = "") -> DataFrame | None:
    """The raw ids of all capture indexes of a place and source. Each reader
    gives an index (tipo, numero) or None where there is none. All or nothing:
    if one fails, also when its rows are read, None, so that the caller takes
    the whole range instead of a part that looks like all."""
    found = []
    for f in read:
        try:
            index = f()
            if index is not None:
                found.append(stored(identities(index)))
        except Exception:  # noqa: BLE001
            return None
    if not found:
        return None
    keys = reduce(lambda a, b: a.union(b), found).distinct()
    return keys.select(F.concat(F.lit(f"{prefix}raw-{ente}-{fonte}-"), "chave").alias("raw_id"))


def missing_files(ids: DataFrame, present: DataFrame) -> tuple[DataFrame, DataFrame]:
    """ids (id) of a full rebuild: those still to fetch, in order, and how many
    are there already, by present (name), names without their ending."""
    have = present.select(F.regexp_replace("name", r"\.xml$", "").alias("id")).distinct()
    return ids.join(have, "id", "left_anti").distinct().orderBy("id"), ids.join(have, "id", "left_semi").agg(F.count("*").alias("skipped"))


def robots_rules(robots: DataFrame) -> DataFrame:
    """robots (host, text) -> host, agent (lower case), allow, path, at: the
    rules of each group, for each agent it names. Groups begin with one or more
    agent lines after a rule."""
    line = F.transform(F.split("text", r"\r?\n", -1), lambda x: F.trim(F.regexp_replace(x, "#.*$", "")))
    rows = robots.select("host", F.posexplode(line).alias("at", "line")).where("line LIKE '%:%'")
    rows = rows.select("host", "at", F.lower(F.trim(F.split_part("line", F.lit(":"), F.lit(1)))).alias("field"), F.trim(F.regexp_replace("line", "^[^:]*:", "")).alias("value")).where("field IN ('user-agent', 'allow', 'disallow')")
    w = Window.partitionBy("host").orderBy("at")
    rows = rows.withColumn("new", (F.col("field") == "user-agent") & (F.coalesce(F.lag("field").over(w), F.lit("")) != "user-agent"))
    rows = rows.withColumn("group", F.sum(F.col("new").cast("int")).over(w))
    agents = rows.where("field = 'user-agent'").select("host", "group", F.lower("value").alias("agent"))
    rules = rows.where("field <> 'user-agent' AND (value <> '' OR field = 'disallow')").select("host", "group", "at", (F.col("field") == "allow").alias("allow"), F.col("value").alias("path"))
    return agents.join(rules, ["host", "group"]).select("host", "agent", "at", F.when(F.col("path") == "", True).otherwise(F.col("allow")).alias("allow"), "path")


def robots_allowed(urls: DataFrame, robots: DataFrame, agent: str) -> DataFrame:
    """urls (url) -> url, allowed. Of the host's groups, one that the agent's
    name contains, else the one for all; in it the first rule that the path
    starts with decides. No rule, or no robots at all: allowed. An address
    without scheme or host is not."""
    pattern = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)(/[^#]*)?"
    own = urls.select("url").distinct().withColumn("host", F.nullif(F.regexp_extract("url", pattern, 1), F.lit(""))).withColumn("path_of", F.coalesce(F.nullif(F.regexp_extract("url", pattern, 2), F.lit("")), F.lit("/")))
    rules = robots_rules(robots).where((F.col("agent") == "*") | F.contains(F.lit(agent.lower()), F.col("agent")))
    # a host's rules for the agent as one array, in order: an address stays one row
    of = lambda k: F.sort_array(F.collect_list(F.when(k, F.struct("at", "path", "allow"))))
    hosts = rules.groupBy("host").agg(of(F.col("agent") != "*").alias("own"), of(F.col("agent") == "*").alias("all"))
    hosts = hosts.select("host", F.when(F.size("own") > 0, F.col("own")).otherwise(F.col("all")).alias("rules"))
    met = own.join(hosts, "host", "left")  # a large host's urls are split, as its rules are one row
    first = F.try_element_at(F.filter("rules", lambda r: F.startswith(F.col("path_of"), r["path"])), F.lit(1))["allow"]
    return met.select("url", (F.col("host").isNotNull() & F.coalesce(first, F.lit(True))).alias("allowed"))


def union_tolerant(strategies: list) -> tuple[DataFrame | None, list[str]]:
    """The rows of all strategies (functions without arguments) that work, and
    what went wrong with the others, be it when their rows are read."""
    found, failed = [], []
    for f in strategies:
        try:
            found.append(stored(f()))
        except Exception as e:  # noqa: BLE001
            failed.append(str(e))
    return (reduce(lambda a, b: a.unionByName(b), found) if found else None), failed
