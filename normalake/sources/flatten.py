"""Canonical law documents to versions rows.

The document is recursive, so no finite schema describes it: one Arrow-batched
Python stage walks the tree and hands down what provisions inherit; derived
columns that need no tree are expressions, over documents where a document has
one value, else over its rows.
"""

from __future__ import annotations

import datetime
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice
from unicodedata import normalize
from xml.etree import ElementTree

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from normalake.functions import law, text
from normalake.operators.quality import require_unique
from normalake.schema import NORMATIVE_TOKENS, ORGANISING_TOKENS, VERSIONS, WHOLE_PATHS
from normalake.sources.tables import stored

#: What a whole law has, and what each wording has.
_LAW = "lei_id string, name string, ente string, urn_lex_lei string, vigente_em date, lei_revogada boolean, lei_revogada_em date, lei_revogada_por string, lei_revogada_tipo string, error string"
_WORDING = (
    "path string, kind string, ordem int, parent string, d_rev boolean, d_rev_em date, d_rev_por string, d_rev_tipo string, em date, ate date, alterado_por string, "
    "has_start boolean, declared string, texto string, normal string, fontes string, num_fontes int, diverges boolean"
)
_ARROW = {"string": pa.string(), "date": pa.date32(), "int": pa.int32(), "boolean": pa.bool_()}
_fields = lambda ddl: [pa.field(n, _ARROW[t]) for n, t in (x.split() for x in ddl.split(","))]
_LAW_FIELDS, _WORDING_FIELDS = _fields(_LAW), _fields(_WORDING)
_NO_WORDING = (None,) * len(_WORDING_FIELDS)
_URN_DATE = re.compile(r":(\d{4}-\d{2}-\d{2})(?:;[a-z0-9.\-]+)?(?:![a-z0-9._\-]+)*$")
_quoted = json.encoder.encode_basestring


@lru_cache(1000)
def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _tag(node) -> str:
    return _local(node.tag)


def _all(node, name: str) -> list:
    return [x for x in node if _tag(x) == name]


def _one(node, name: str):
    return next(iter(_all(node, name)), None)


@lru_cache(10_000)
def day(s: str | None) -> datetime.date | None:
    try:
        return datetime.date.fromisoformat(re.sub(r"([+-]\d{2}:\d{2}|Z)$", "", s)) if s else None
    except ValueError:
        return None


def _patterns() -> Iterator[tuple[re.Pattern, list[tuple[re.Pattern, str]]]]:
    """Of each class of tokens: whole paths, and paths that end in each token."""
    # $ as Java's has it
    compiled = lambda p: re.compile(p + r"(?=(?:\r\n|[\n\r\x85\u2028\u2029])?\Z)", re.ASCII)
    for tokens in ({**NORMATIVE_TOKENS, "titulo-lei": "titulo-lei"}, ORGANISING_TOKENS):
        every = "|".join(tokens)
        yield compiled(rf"(?:{every})(?:-(?:{every}))*"), [(compiled(rf"(?:(?:{every})-)*(?:{t})"), kind) for t, kind in tokens.items()]


_PATTERNS = list(_patterns())


@lru_cache(10_000)
def _kind(path: str) -> str | None:
    """law.path_kind() of one path, for a walk that meets the same ones over and
    over."""
    for whole, ends in _PATTERNS:
        if whole.match(path) and (kind := next((k for p, k in ends if p.match(path)), None)):
            return WHOLE_PATHS.get(path, kind)
    return WHOLE_PATHS.get(path)


def _sources(found: list) -> tuple[str, int, bool]:
    """The sources as JSON, their number, and whether one diverges."""
    out, some = [], False
    for f in found:
        diverges = (f.get("diverge") or "").strip().lower() in ("true", "1")
        other = _one(f, "texto") if diverges else None
        said = "null" if other is None or other.text is None else _quoted(other.text)
        out.append(f'{{"ia_id": {_quoted(f.get("ia-id", ""))}, "diverge": {"true" if diverges else "false"}, "texto_divergente": {said}}}')
        some = some or diverges
    return f"[{', '.join(out)}]", len(out), some


def _parts(node, *names: str) -> list[list]:
    """The children of each name, in one pass."""
    out = {n: [] for n in names}
    for x in node:
        if (at := out.get(_local(x.tag))) is not None:
            at.append(x)
    return list(out.values())


def walk(xml: str) -> tuple[tuple, Iterator[tuple]]:
    """What the whole law has from its URN on, and a row for each wording,
    parents before children."""
    root = ElementTree.fromstring(xml)
    urn, gone = root.get("urn-lex"), _one(root, "revogacao")
    m = _URN_DATE.search(urn or "")
    published = day(m[1]) if m and (urn or "").startswith("urn:lex:br") else None
    get = lambda node, name: None if node is None else node.get(name)
    law_end = day(get(gone, "em"))
    return (urn, day(root.get("vigente-em")), gone is not None, law_end, get(gone, "por"), get(gone, "tipo")), _wordings(root, published, law_end)


def _wordings(root, published: datetime.date | None, law_end: datetime.date | None) -> Iterator[tuple]:
    # (element, its place, parent's path, inherited start, inherited end); a stack, as nesting may be deep
    todo = [(x, i, None, published, None) for i, x in enumerate(_all(root, "dispositivo"))][::-1]
    while todo:
        node, place, parent, start, end = todo.pop()
        versions, gone, inner = _parts(node, "versao", "revogacao", "dispositivo")
        path, own = node.get("path", ""), gone[0].get if gone else {}.get
        own_end = day(own("em"))
        starts = [day(v.get("em")) if v.get("em") else start or published for v in versions]
        ends = [*starts[1:], own_end or end or law_end]
        provision = (path, _kind(path), place, parent, bool(gone), own_end, own("por"), own("tipo"))
        for v, em, ate in zip(versions, starts, ends):
            begin, body, sources = _parts(v, "inicio", "texto", "fonte")
            said = body[0].text if body else None
            # as text.normalize_text has it; null if it is the text itself
            normal = " ".join(normalize("NFC", said).split()) if said else None
            yield *provision, em, ate, v.get("alterado-por"), bool(begin), begin[0].get("tipo") if begin else None, said, None if normal == said else normal, *_sources(sources)
        below = starts[0] if starts else start
        todo += [(x, i, path, below, own_end or end) for i, x in enumerate(inner)][::-1]


def in_batches(rows: Iterator[tuple], names: list[str], most: int = 2000) -> Iterator[pd.DataFrame]:
    """Frames of so many rows at most: a batch of documents is not held as rows
    all at once, however many each document has."""
    while batch := list(islice(rows, most)):
        # plain objects: a string column of several Arrow chunks is not taken back
        yield pd.DataFrame(batch, columns=names, dtype=object)


def _walk_all(frames: Iterable, most: int = 2000) -> Iterator[pa.RecordBatch]:
    """A row for each wording, of so many at most in a batch; ``doc`` counts the
    batch's documents. Columns are filled from lists, without frames between."""

    def rows() -> Iterator[tuple[tuple, tuple]]:
        for frame in frames:
            for lei, name, ente, xml in zip(frame["lei_id"], frame.get("name", frame["lei_id"]), frame["ente"], frame["xml"]):
                try:
                    law, wordings = walk(xml or "")
                except ElementTree.ParseError as e:
                    yield (lei, name, ente, *[None] * 6, str(e)), _NO_WORDING
                    continue
                law = (lei, name, ente, *law, None)
                for row in wordings:
                    yield law, row

    every = rows()
    while batch := list(islice(every, most)):
        laws, doc = [], []
        for law, _ in batch:
            if not laws or law is not laws[-1]:
                laws.append(law)
            doc.append(len(laws) - 1)
        at = pa.array(doc, pa.int32())
        whole = [pa.array(x, f.type).take(at) for x, f in zip(zip(*laws), _LAW_FIELDS)]
        each = [pa.array(x, f.type) for x, f in zip(zip(*[row for _, row in batch]), _WORDING_FIELDS)]
        yield pa.RecordBatch.from_arrays([*whole, *each, at], schema=pa.schema([*_LAW_FIELDS, *_WORDING_FIELDS, pa.field("doc", pa.int32())]))


def _walk_laws(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document of a batch, with its wordings there as a list."""
    # a few documents at once are Python's strings
    frames = (b.slice(i, 200).to_pydict() for b in batches for i in range(0, b.num_rows, 200))
    for found in _walk_all(frames):
        first = np.flatnonzero(np.diff(found["doc"].to_numpy(), prepend=-1))
        wordings = pa.StructArray.from_arrays([found[f.name] for f in _WORDING_FIELDS], fields=_WORDING_FIELDS)
        lists = pa.ListArray.from_arrays(pa.array([*first, found.num_rows], pa.int32()), wordings)
        yield pa.RecordBatch.from_arrays([*[found[f.name].take(pa.array(first)) for f in _LAW_FIELDS], lists], names=[*[f.name for f in _LAW_FIELDS], "wordings"])


def walked(docs: DataFrame) -> DataFrame:
    """docs (lei_id, ente, xml and perhaps name) -> a row for each document, with
    its wordings, or several if they are many; for one that cannot be parsed, a
    row with its error. A document without wordings gives none."""
    name = F.col("name" if "name" in docs.columns else "lei_id").alias("name")
    within = ", ".join(":".join(x.split()) for x in _WORDING.split(","))
    return docs.select("lei_id", name, "ente", "xml").mapInArrow(_walk_laws, f"{_LAW}, wordings array<struct<{within}>>")


def unparsed(docs: DataFrame) -> DataFrame:
    """docs (lei_id, xml) -> lei_id, error: those that cannot be parsed, without
    the rows of the others."""

    def failed(frame: pd.DataFrame) -> Iterator[tuple]:
        for lei, xml in zip(frame["lei_id"], frame["xml"]):
            try:
                ElementTree.fromstring(xml or "")
            except ElementTree.ParseError as e:
                yield lei, str(e)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield from in_batches(failed(frame), ["lei_id", "error"])

    return docs.select("lei_id", "xml").mapInPandas(run, "lei_id string, error string")


def law_fields(lei_id, urn, prefix: str = "norma"):
    """struct(tipo, numero, ano): from the URN, else from the id's fallback
    form, else from its canonical form, else unknown."""
    of = lambda p: law.urn_part(urn, p)
    fallback = rf"^{prefix}-[^-]+-(.+?)-fallback-.+$"
    canonical = rf"^{prefix}-[^-]+-(.+)-(\d+)-(\d{{4}})$"
    number = F.coalesce(F.nullif(F.regexp_replace(F.regexp_extract(lei_id, canonical, 2), "^0+", ""), F.lit("")), F.lit("0"))
    make = lambda t, n, y: F.struct(t.alias("tipo"), n.cast("string").alias("numero"), y.cast("int").alias("ano"))
    return (
        F.when(of("tipo").isNotNull(), make(of("tipo"), of("numero"), F.substring(of("data"), 1, 4)))
        .when(lei_id.rlike(fallback), make(F.regexp_extract(lei_id, fallback, 1), F.lit(None), F.lit(0)))
        .when(lei_id.rlike(canonical), make(F.regexp_extract(lei_id, canonical, 1), number, F.regexp_extract(lei_id, canonical, 3)))
        .otherwise(make(F.lit("desconhecido"), F.lit(None), F.lit(0)))
    )


def flatten(docs: DataFrame, prefix: str = "norma") -> DataFrame:
    """The versions rows of all documents that can be parsed, in VERSIONS. What
    an id says of its law is read from the document's name, if docs have one: an
    id may be too short for the whole number."""
    c = F.col
    # once for each document, before its wordings are rows
    fields = law_fields(c("name"), c("urn_lex_lei"), prefix)
    laws = walked(docs).where("error IS NULL").withColumn("f", fields).withColumn("day", law.urn_part(c("urn_lex_lei"), "data"))
    laws = laws.withColumn("data_publicacao", F.when(F.length("day") == 10, F.try_to_date("day", "yyyy-MM-dd")))
    rows = laws.select("*", F.inline("wordings"))
    new = {
        "tipo_lei": c("f.tipo"), "numero_lei": c("f.numero"), "ano_lei": c("f.ano"),
        "dispositivo_path": c("path"), "dispositivo_tipo": F.coalesce("kind", F.lit("desconhecido")), "dispositivo_ordem": c("ordem"), "dispositivo_parent_path": c("parent"),
        "dispositivo_revogado": c("d_rev"), "dispositivo_revogado_em": c("d_rev_em"), "dispositivo_revogado_por": c("d_rev_por"), "dispositivo_revogado_tipo": c("d_rev_tipo"),
        "urn_dispositivo": F.when(c("urn_lex_lei") != "", F.concat("urn_lex_lei", F.lit("!"), "path")), "versao_id": law.version_id(c("lei_id"), c("path"), c("em")),
        "inicio_tipo": law.start_kind(c("declared"), c("has_start"), c("alterado_por")), "texto_normalizado": F.when(c("texto") != "", F.coalesce("normal", "texto")), "hash_texto": text.hash_text(c("texto")),
        "tem_divergencia": c("diverges"), "quality": F.lit(None).cast("string"),
    }
    return rows.select(*[new.get(f.name, c(f.name)).cast(f.dataType).alias(f.name) for f in VERSIONS])


def _rules(xml: str, namespace: str) -> Iterator[tuple[int, str]]:
    """Broken rules (number, what) of one document."""
    try:
        root = ElementTree.fromstring(xml)
    except ElementTree.ParseError as e:
        yield 0, str(e)
        return
    if root.tag != f"{{{namespace}}}lei":
        yield 15, root.tag
        return
    diverges = lambda f: (f.get("diverge") or "").strip() in ("true", "1")
    whole = _one(root, "revogacao") is not None
    for node in root.iter():
        kind = _tag(node)
        if kind == "versao":
            # an xs:boolean: true, false, 1 or 0
            yield from ((1, f.get("ia-id", "?")) for f in _all(node, "fonte") if diverges(f) != (_one(f, "texto") is not None))
        elif kind in ("inicio", "revogacao"):
            yield from ((1, f.get("ia-id", "?")) for f in _all(node, "fonte") if f.get("diverge") is not None)
        if kind == "revogacao" and node.get("tipo") and (node.get("tipo") == "caducidade") == (node.get("por") is not None):
            yield 3, node.get("em", "?")
        if kind == "dispositivo" and whole and _one(node, "revogacao") is not None:
            yield 2, node.get("path", "?")


def broken_rules(docs: DataFrame, namespace: str) -> DataFrame:
    """docs (lei_id, xml) -> file, rule, message: what only the tree shows.
    Rule 0 is a document that cannot be parsed, 15 one with another root; both
    end its checks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = ((lei, rule, said) for lei, xml in zip(frame["lei_id"], frame["xml"]) for rule, said in _rules(xml or "", namespace))
            yield from in_batches(rows, ["file", "rule", "message"])

    return docs.select("lei_id", "xml").mapInPandas(run, "file string, rule int, message string")


def consolidate(docs: DataFrame, prefix: str = "norma") -> DataFrame:
    """flatten(), and a version id must not repeat. The rows are stored before
    they are checked, so documents are walked once."""
    return require_unique(stored(flatten(docs, prefix)), "versao_id")


