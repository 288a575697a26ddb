"""Sinks: Parquet, CSV, JSON lines, sidecars and the exchange XML."""

from __future__ import annotations

import hashlib
import json
import random
import re
import subprocess
import time
from collections.abc import Callable, Iterator
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from normalake.functions import law
from normalake.functions.identity import bundle_id, snapshot_stamp
from normalake.schema import EXPORT_COLUMNS
from normalake.sources.tables import numbered  # noqa: F401


def write_versions(df: DataFrame, path: str, files: int | None = None) -> None:
    """Snappy Parquet; nothing to write is an error. Rows of one norm lie
    together, so that statistics prune a look-up by norm."""
    if not df.take(1):
        raise ValueError("no rows to write")
    df = df.repartitionByRange(files, "lei_id") if files else df.repartitionByRange("lei_id")
    df.sortWithinPartitions("lei_id", "dispositivo_path").write.mode("overwrite").option("compression", "snappy").parquet(path)


def export_laws(df: DataFrame, folder: str, ente: str | None = None, year: int | None = None) -> str:
    """Staging rows of a place and year; the path says which."""
    if ente:
        df = df.where(F.col("ente") == ente)
    if year:
        df = df.where(F.col("ano") == year)
    path = f"{folder}/normas-{ente or 'todas'}{f'-{year}' if year else ''}.parquet"
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def rows_json(df: DataFrame) -> DataFrame:
    """One column json: export columns in their order, days as text."""
    day = {f.name for f in df.schema if f.dataType.typeName() == "date"}
    cols = [(law.iso_date(F.col(c)) if c in day else F.col(c)).alias(c) for c in EXPORT_COLUMNS]
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("json"))


#: A gzip file is read by one task, so none holds more rows than this.
_ROWS_A_FILE = 250_000


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """RFC 4180: CRLF, quotes doubled, null empty."""
    rows = df.select(*EXPORT_COLUMNS).write.mode("overwrite").option("compression", compression)
    if compression != "none":
        rows = rows.option("maxRecordsPerFile", _ROWS_A_FILE)
    rows.option("header", True).option("escape", '"').option("lineSep", "\r\n").option("emptyValue", "").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines without nulls, by gzip: the names of columns are most of them."""
    df.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", _ROWS_A_FILE).json(path)


def write_pool(df: DataFrame, path: str) -> int:
    """JSON lines; the count is taken as they are written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(path)
    return seen.get["n"]


def write_manifest(manifest: DataFrame, path: str, **about) -> None:
    """The pool's manifest (a row for each source, so a few rows) as one JSON
    file: what is said about the draw, totals and the sources."""
    rows = [r.asDict() for r in manifest.orderBy(manifest.columns[0]).collect()]
    totals = {c: sum(r[c] for r in rows) for c in manifest.columns[1:]}
    text = json.dumps({**about, **totals, "sources": rows}, ensure_ascii=False, indent=2)
    manifest.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def raw_meta(df: DataFrame, captured: str, bundle: str) -> DataFrame:
    """df (id, content, origin_url, snapshot) -> id, json."""
    c = F.col
    body = F.struct(c("id").alias("raw_id"), F.sha2("content", 256).alias("sha256"), F.lit(captured).alias("captured_at"), F.lit(bundle).alias("bundle"), F.struct("origin_url", "snapshot").alias("provenance"))
    return df.select("id", F.to_json(body, {"ignoreNullFields": "false"}).alias("json"))


def raw_sidecar(df: DataFrame, captured: str, day: Column, agent: str, html: bool = False) -> DataFrame:
    """df (ente, fonte, chave, fonte_url, content, fetched_from, wayback_url,
    blocked) -> chave, json: what is kept beside a captured file. A page says so
    and its digest is of its text; a snapshot's time is read from its address."""
    kind = "html" if html else "pdf"
    digest = F.concat(F.lit("sha256:"), F.sha2(F.col("content").cast("binary"), 256)).alias(f"hash_{kind}")
    origin = F.struct("fetched_from", "wayback_url", snapshot_stamp(F.col("wayback_url")).alias("wayback_timestamp"), F.coalesce("blocked", F.lit(False)).alias("wayback_blocked_robots")).alias("provenance_wayback")
    head = [F.lit("0.1").alias("meta_version"), *([F.lit("html").alias("content_type")] if html else [])]
    body = F.struct(*head, "ente", "fonte", "chave", "fonte_url", F.lit(captured).alias("data_captura"), digest, F.lit(agent).alias("user_agent"), bundle_id(F.col("ente"), F.col("fonte"), day).alias("id_bundle"), origin)
    return df.select("chave", F.to_json(body, {"ignoreNullFields": "false"}).alias("json"))


def _streamed_digest(spark: SparkSession, path: str) -> str:
    """SHA-256 of a file of any size, read as a stream by the file system."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).open(at)
    try:
        return jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
    finally:
        stream.close()


def file_digests(spark: SparkSession, path: str, whole: int = 1 << 28) -> list[tuple[str, int, str]]:
    """(name, bytes, SHA-256) of a dataset's files by name. Files up to
    ``whole`` bytes are digested by tasks, in memory; larger ones, which no
    task should hold, one after the other as streams."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    few = files.where(F.col("length") <= whole).select("path", "length", F.sha2("content", 256).alias("sha"))
    found = {r.path: (r.length, r.sha) for r in few.collect()}  # one row a file
    found |= {r.path: (r.length, _streamed_digest(spark, r.path)) for r in files.where(F.col("length") > whole).select("path", "length").collect()}
    return sorted((p.rpartition("/")[2], n, sha) for p, (n, sha) in found.items())


def dataset_meta(spark: SparkSession, path: str, version: str, created: str, git_sha: str | None = None, whole: int = 1 << 28) -> str:
    """row_count, bytes and a digest of a dataset's files: of several, the
    digest of their digests in the order of names."""
    found = file_digests(spark, path, whole)
    digest = found[0][2] if len(found) == 1 else hashlib.sha256("".join(sha for _, _, sha in found).encode()).hexdigest()
    meta = {"dataset_version": version, "created_at": created, "row_count": spark.read.parquet(path).count(), "file_size_bytes": sum(n for _, n, _ in found), "hash_parquet": f"sha256:{digest}"}
    return json.dumps(meta | ({"git_sha": git_sha} if git_sha else {}), ensure_ascii=False, indent=2)


def with_retry(run: Callable[[], tuple[bool, str]], retryable: str = r"(?i)reduce your request rate|slow ?down|timed? ?out|50[0234]|429", attempts: int = 5, base: float = 2.0, most: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> bool:
    """run() says whether it worked and what it complained of; only complaints
    that fit retryable are tried again, each wait twice the last."""
    for n in range(1, attempts + 1):
        ok, said = run()
        if ok:
            return True
        if n == attempts or not re.search(retryable, said):
            return False
        sleep(min(most, base * 2 ** (n - 1)) * (1 + random.random() * 0.25))
    return False


def run_command(args: list[str]) -> tuple[bool, str]:
    done = subprocess.run(args, capture_output=True, text=True, check=False)
    return done.returncode == 0, done.stderr


def triggers(spark: SparkSession, path: str, probe_ms: float, most_mb: float = 100, most_rows: int = 2_000_000, most_ms: float = 1000) -> list[str]:
    """Which limits a dataset is over; two or more ask for a split."""
    size = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).agg(F.sum("length")).collect()[0][0] or 0
    checks = (("size", size / 2**20 > most_mb), ("rows", spark.read.parquet(path).count() > most_rows), ("latency", probe_ms > most_ms))
    return [name for name, over in checks if over]


def summary(counts: dict[str, int], most_percent: float = 20.0) -> str:
    """Markdown of a batch's counters and its failure rate."""
    total = sum(counts.values())
    rate = 100 * counts.get("failed", 0) / total if total else 0.0
    lines = [f"| {k} | {v} |" for k, v in counts.items()]
    return "\n".join(["| result | n |", "|-|-|", *lines, "", f"failure rate {rate:.1f} %" + (" (over the limit)" if rate > most_percent else "")])


def lexml(df: DataFrame) -> DataFrame:
    """versions -> lei_id, xml: a reduced exchange document for each norm with
    each provision's last wording. A norm's provisions are a bounded tree."""
    last = df.groupBy("lei_id", "urn_lex_lei", "dispositivo_path", "dispositivo_parent_path", "dispositivo_ordem").agg(F.max_by("texto", F.struct(law.date_ms(F.col("em")), "versao_id")).alias("texto"))
    # ids and labels depend on the path alone, so each path has them made once
    paths = df.select(F.col("dispositivo_path").alias("_p")).distinct().select("_p", law.lexml_id(F.col("_p")).alias("id"), law.short_label(F.col("_p")).alias("rotulo"))
    labelled = last.join(paths, F.col("dispositivo_path").eqNullSafe(F.col("_p")))
    one = F.struct(F.col("dispositivo_ordem").isNull(), "dispositivo_ordem", "dispositivo_path", "dispositivo_parent_path", "id", "rotulo", "texto")
    norms = labelled.groupBy("lei_id").agg(F.min("urn_lex_lei").alias("urn"), F.to_json(F.sort_array(F.collect_list(one)), {"ignoreNullFields": "false"}).alias("rows"))

    def build(urn: str | None, rows: list[list]) -> str:
        children: dict = {}
        there = {path for path, *_ in rows}
        for path, parent, *what in rows:
            children.setdefault(parent if parent in there and parent != path else None, []).append((path, *what))

        def render(parent) -> Iterator[str]:
            for path, name, label, body in children.get(parent, []):
                yield f"<Dispositivo id={quoteattr(name)}><Rotulo>{escape(label)}</Rotulo><p>{escape(body or '')}</p>{''.join(render(path))}</Dispositivo>"

        return f"<LexML><Metadado><Identificacao URN={quoteattr(urn or '')}/></Metadado><Norma>{''.join(render(None))}</Norma></LexML>"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            xml = [build(urn, [list(r.values())[2:] for r in json.loads(rows)]) for urn, rows in zip(frame["urn"], frame["rows"])]
            yield pd.DataFrame({"lei_id": frame["lei_id"], "xml": xml}, dtype=object)

    return norms.mapInPandas(run, "lei_id string, xml string")
