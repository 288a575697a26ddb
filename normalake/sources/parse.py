"""The pluggable parse stage and the annotation tools."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OCR_MOST, HTML_MOST, CONFIDENCE = 8_000, 32_000, 0.5


def first_object(text: str | None) -> dict | None:
    """The whole text as a JSON object, else the first that starts at any
    brace, also within a list."""
    text = text or ""
    try:
        whole = json.loads(text)
        if isinstance(whole, dict):
            return whole
    except ValueError:
        pass
    decoder = json.JSONDecoder()
    at = text.find("{")
    while at >= 0:
        try:
            found = decoder.raw_decode(text, at)[0]
            if isinstance(found, dict):
                return found
        except ValueError:
            pass
        at = text.find("{", at + 1)
    return None


def accepted(found: dict | None) -> bool:
    """Confidence is a finite number of at least CONFIDENCE, and tipo, numero
    (digits) and ano are there."""
    if not found:
        return False
    try:
        sure, year = float(found.get("confidence")), int(found.get("ano"))
    except (TypeError, ValueError):
        return False
    return math.isfinite(sure) and sure >= CONFIDENCE and bool(found.get("tipo")) and str(found.get("numero", "")).isdigit() and year > 0


def parse(rows: DataFrame, model: Callable[[str], str], html: bool = False) -> DataFrame:
    """rows (id, text) -> id, json, ok: model(text) answers in free text. It is
    given from outside, so that tests and offline runs need no service."""
    most = HTML_MOST if html else OCR_MOST

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            got = [first_object(model((t or "")[:most])) for t in frame["text"]]
            yield pd.DataFrame({"id": frame["id"], "json": [None if g is None else json.dumps(g, ensure_ascii=False) for g in got], "ok": [accepted(g) for g in got]}, dtype=object)

    return rows.select("id", "text").mapInPandas(run, "id string, json string, ok boolean")


def outcome(said: str | None, raw_id: str, ente: str, prefix: str = "norma") -> tuple[str | None, str | None, str | None, float | None]:
    """(reason, parsed id, document, confidence) of a model's answer; the reason
    is null if it is taken. The first check that fails is the reason: ``answer``
    (no JSON object), ``confidence`` (no finite number of CONFIDENCE or more),
    ``document`` (missing or not well-formed), ``provenance`` (each wording must
    have one source, the raw id), ``fields`` (tipo, numero or ano missing),
    ``number`` (not digits), ``year``."""
    found = first_object(said)
    if found is None:
        return "answer", None, None, None
    try:
        sure = float(found.get("confidence", 0.0))
    except (TypeError, ValueError):
        return "confidence", None, None, None
    if not math.isfinite(sure) or sure < CONFIDENCE:
        return "confidence", None, None, sure if math.isfinite(sure) else None
    xml = found.get("xml")
    try:
        root = ElementTree.fromstring(xml) if isinstance(xml, str) and xml else None
    except (ElementTree.ParseError, ValueError):
        root = None
    if root is None:
        return "document", None, None, sure
    local = lambda x: x.tag.rpartition("}")[2]
    for version in (x for x in root.iter() if local(x) == "versao"):
        ids = [x.get("ia-id") for x in version if local(x) == "fonte"]
        if ids != [raw_id]:
            return "provenance", None, None, sure
    kind, number, year = (found.get(k) for k in ("tipo", "numero", "ano"))
    if not kind or number is None or not year:
        return "fields", None, None, sure
    number = str(number).strip()
    if not (number.isascii() and number.isdigit()):
        return "number", None, None, sure
    try:
        year = int(year)
    except (TypeError, ValueError, OverflowError):
        return "year", None, None, sure
    return None, f"{prefix}-{ente}-{kind}-{number.zfill(5)}-{year}", xml, sure


def assembled(rows: DataFrame, model: Callable[[str], str], html: bool = False, prefix: str = "norma") -> DataFrame:
    """rows (raw_id, ente, text) -> raw_id, ente, reason, lei_id, xml,
    confidence: every row with its document, ready for flatten(), or with the
    reason why there is none. The model gets the text up to its limit and
    answers in free text; it is given from outside."""
    most = HTML_MOST if html else OCR_MOST

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [(r.raw_id, r.ente, *outcome(model((r.text or "")[:most]), r.raw_id, r.ente, prefix)) for r in frame.itertuples()]
            yield pd.DataFrame(out, columns=["raw_id", "ente", "reason", "lei_id", "xml", "confidence"], dtype=object)

    return rows.select("raw_id", "ente", "text").mapInPandas(run, "raw_id string, ente string, reason string, lei_id string, xml string, confidence double")


def parsed_meta(found: DataFrame, method: str, at: str) -> DataFrame:
    """assembled() rows that were taken -> lei_id, json: the record of a parse."""
    body = F.struct(F.lit("0.1").alias("meta_version"), F.col("raw_id").alias("id_raw"), F.col("lei_id").alias("id_parsed"), "ente", F.lit(method).alias("parse_method"), F.col("confidence").alias("confianca_parse_global"), F.lit(at).alias("parse_timestamp"), F.array("raw_id").alias("fontes_consultadas"), F.lit(False).alias("tem_divergencia"), F.lit(0).alias("num_divergencias"))
    return found.where("reason IS NULL").select("lei_id", F.to_json(body).alias("json"))


def occurrence(text: str, needle: str, n: int = 1) -> tuple[int, int] | None:
    """Where the n-th occurrence stands; they may overlap."""
    at = -1
    for _ in range(n):
        at = text.find(needle, at + 1) if needle else -1
        if at < 0:
            return None
    return at, at + len(needle)


def preview(text: str, label: list[dict]) -> str:
    """The text with each span in brackets, headed by its category."""
    for s in sorted(label, key=lambda s: -s["start"]):
        text = f"{text[: s['start']]}[{s['category']}: {text[s['start'] : s['end']]}]{text[s['end'] :]}"
    return text


def invalid_spans(records: DataFrame, categories: list[str]) -> DataFrame:
    """records (doc, text, label) -> doc, category, start, end, why."""
    s = records.select("doc", F.length("text").alias("n"), F.explode("label").alias("s")).select("doc", "n", "s.*")
    why = F.when(~F.col("category").isin(*categories), "unknown category").when((F.col("start") < 0) | (F.col("end") > F.col("n")) | (F.col("start") >= F.col("end")), "bad offsets")
    return s.withColumn("why", why).where("why IS NOT NULL").drop("n")
