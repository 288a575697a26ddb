"""The exchange format: a reduced document for each norm, one for each annex.

The tree is walked once for its provisions, in document order, each with the
places and paths down to it.  Everything else is columns: which element a
provision becomes under its parent's, the elements that stay open after it, and
so its own piece of the text.  A norm's pieces, put in order, are its document;
no step renders a norm by itself.

Of a provision's wordings the last by document order counts.  Provisions that
the format has no place for are left out with what hangs on them.
"""

from __future__ import annotations

from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from normalake.sources.flatten import _all, _one, _tag, in_batches

_NODE = "doc long, lei_id string, urn string, places array<int>, paths array<string>, texto string, revogado boolean"
#: Organisational tokens, the last that a path has decides; how their ids begin.
GROUPS = (("subsec", "Subsecao", "sub"), ("sec", "Secao", "sec"), ("cap", "Capitulo", "cap"), ("tit", "Titulo", "tit"), ("liv", "Livro", "liv"), ("parte", "Parte", "prt"))
OPENING = (("titulo-lei", "Epigrafe", "epi1"), ("ementa", "Ementa", "ementa1"), ("preambulo", "Preambulo", "pre1"))
FALLBACK_URN = "urn:lex:br;norma;fallback:0000-00-00;0"


def _nodes(doc: int, lei: str, xml: str) -> Iterator[tuple]:
    root = ElementTree.fromstring(xml)
    if _tag(root) != "lei":
        return
    urn = root.get("urn-lex")
    todo = [(x, [i], [x.get("path", "")]) for i, x in enumerate(_all(root, "dispositivo"))][::-1]
    while todo:
        node, places, paths = todo.pop()
        versions = _all(node, "versao")
        body = _one(versions[-1], "texto") if versions else None
        yield doc, lei, urn, places, paths, "" if body is None else "".join(body.itertext()), _one(node, "revogacao") is not None
        todo += [(x, [*places, i], [*paths, x.get("path", "")]) for i, x in enumerate(_all(node, "dispositivo"))][::-1]


def nodes(docs: DataFrame) -> DataFrame:
    """docs (lei_id, xml) -> a row for each provision, with a number of its
    document for this run; documents that cannot be parsed, or with another
    root, have none."""

    def rows(frame: pd.DataFrame) -> Iterator[tuple]:
        for doc, lei, xml in zip(frame["doc"], frame["lei_id"], frame["xml"]):
            try:
                yield from _nodes(doc, lei, xml or "")
            except ElementTree.ParseError:
                pass

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield from in_batches(rows(frame), ["doc", "lei_id", "urn", "places", "paths", "texto", "revogado"])

    return docs.select(F.monotonically_increasing_id().alias("doc"), "lei_id", "xml").mapInPandas(run, _NODE)


def _escaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _quoted(c: Column) -> Column:
    return F.replace(_escaped(c), F.lit('"'), F.lit("&quot;"))


def _after(c: Column, mark: str) -> Column:
    """What stands after the first mark, else nothing."""
    return F.when(F.instr(c, mark) > 0, F.substring(c, F.instr(c, mark) + len(mark), F.lit(2**31 - 1))).otherwise("")


def element(path: Column, parent: Column, above: Column) -> Column:
    """The element of a provision under one of element ``parent`` (none at the
    top) with path ``above``, or null."""
    grouped = F.coalesce(parent, F.lit("")).isin("", *(name for _, name, _ in GROUPS))
    at_top = F.when(path.isin(*(p for p, _, _ in OPENING)), F.lit(None).cast("string")).when(F.startswith(path, F.lit("art-")), "Artigo")
    for token, name, _ in GROUPS:
        at_top = at_top.when(F.contains(path, F.lit(f"-{token}-")) | F.startswith(path, F.lit(f"{token}-")), name)
    at_top = at_top.when(path.rlike("^disp-(transitoria|final)-"), "Artigo")
    below = (
        F.when((parent == "Artigo") & F.startswith(path, F.concat(above, F.lit("-inc-"))), "Inciso")
        .when((parent == "Artigo") & F.contains(path, F.lit("-par-")) & (F.instr(_after(path, "-par-"), "-") == 0), "Paragrafo")
        .when((parent == "Paragrafo") & F.contains(path, F.lit("-inc-")), "Inciso")
        .when((parent == "Inciso") & F.contains(path, F.lit("-ali-")), "Alinea")
        .when((parent == "Alinea") & F.contains(path, F.lit("-item-")), "Item")
    )
    return F.when(grouped, at_top).otherwise(below)


def article_id(path: Column) -> Column:
    """A path's id below an article: art-5-par-unico-inc-2-ali-c-item-1 becomes
    art5_par1u_inc2_ali3_ite1. Letters become places, an item of the caput gets
    ``_cpt`` before it, and a letter after the article's number is dropped."""
    rest = _after(path, "art-")
    number = F.substring_index(rest, "-", 1)
    tail = F.substring(rest, F.length(number) + 1, F.lit(2**31 - 1))
    known = r"^(?:-par-([^-]*))?(?:-inc-([^-]*))?(?:-ali-(.)[^-]*)?(?:-item-([^-]*))?"
    part = lambda n: F.regexp_extract(tail, known, n)
    paragraph = F.when(part(1) == "unico", "1u").otherwise(part(1))
    letter = F.greatest(F.lit(1), F.instr(F.lit("abcdefghijklmnopqrstuvwxyz"), part(3)))
    return F.concat(
        F.lit("art"), number, F.when(part(1) != "", F.concat(F.lit("_par"), paragraph)).otherwise(""),
        F.when(part(2) != "", F.concat(F.when(part(1) == "", "_cpt").otherwise(""), F.lit("_inc"), part(2))).otherwise(""),
        F.when(part(3) != "", F.concat(F.lit("_ali"), letter.cast("string"))).otherwise(""), F.when(part(4) != "", F.concat(F.lit("_ite"), part(4))).otherwise(""),
    )


def group_id(path: Column) -> Column:
    """tit-2-cap-1-subsec-3 becomes tit2_cap1_sub3."""
    out = path
    for token, _, short in GROUPS:
        out = F.regexp_replace(out, rf"(^|-){token}-([^-]*)", rf"$1{short}$2")
    return F.replace(out, F.lit("-"), F.lit("_"))


def _label(path: Column, kind: Column, text: Column) -> Column:
    paragraph = _after(path, "-par-")
    return (
        F.when(kind == "Artigo", F.concat(F.lit("Art. "), _after(path, "art-")))
        .when(kind == "Paragrafo", F.when(paragraph == "unico", "Parágrafo único").otherwise(F.concat(F.lit("§ "), paragraph)))
        .when(kind == "Inciso", _after(path, "-inc-"))
        .when(kind == "Alinea", F.concat(_after(path, "ali-"), F.lit(")")))
        .when(kind == "Item", _after(path, "item-"))
        .otherwise(text)
    )


def _pieces(rows: DataFrame) -> DataFrame:
    """Provisions with a place in the document: doc, place (an order key)
    and piece: what the provision opens, and what closes before the next."""
    c = F.col
    state = "struct<kind: string, path: string, ok: boolean, elements: array<string>, place: array<struct<late: int, at: int>>, n: int>"
    start = F.struct(F.lit(None).cast("string").alias("kind"), F.lit("").alias("path"), F.lit(True).alias("ok"), F.array().cast("array<string>").alias("elements"), F.array().cast("array<struct<late: int, at: int>>").alias("place"), F.lit(0).alias("n")).cast(state)

    def down(s: Column, path: Column) -> Column:
        kind = element(path, s["kind"], s["path"])
        at = F.element_at("places", s["n"] + 1)
        key = F.array_join(F.slice("places", 1, s["n"] + 1), ".")
        # what hangs on an article, but for paragraphs, hangs on its caput
        caput = F.when((s["kind"] == "Artigo") & (kind == "Inciso"), s["elements"]).otherwise(F.when(s["kind"] == "Artigo", F.slice(s["elements"], 1, F.greatest(F.lit(0), F.size(s["elements"]) - 1))).otherwise(s["elements"]))
        own = F.when(kind == "Artigo", F.array(F.concat(F.lit("Artigo:"), key), F.concat(F.lit("Caput:"), key))).otherwise(F.array(F.concat(kind, F.lit(":"), key)))
        late = F.struct(F.when(kind == "Paragrafo", 1).otherwise(0).alias("late"), at.alias("at"))
        return F.struct(kind.alias("kind"), path.alias("path"), (s["ok"] & kind.isNotNull()).alias("ok"), F.concat(caput, own).alias("elements"), F.concat(s["place"], F.array(late)).alias("place"), (s["n"] + 1).alias("n")).cast(state)

    met = rows.withColumn("s", F.aggregate("paths", start, down)).where("s.ok").select("doc", "texto", "revogado", "s.kind", "s.path", "s.elements", "s.place")
    following = F.lead("elements").over(Window.partitionBy("doc").orderBy("place"))
    met = met.withColumn("next", F.coalesce(following, F.array().cast("array<string>")))
    differs = F.array_position(F.zip_with("elements", "next", lambda a, b: a.eqNullSafe(b)), F.lit(False))
    shut = F.when(differs == 0, F.array().cast("array<string>")).otherwise(F.slice("elements", differs.cast("int"), F.size("elements")))
    closing = F.array_join(F.transform(F.reverse(shut), lambda e: F.concat(F.lit("</"), F.substring_index(e, ":", 1), F.lit(">"))), "")
    grouped = c("kind").isin(*(name for _, name, _ in GROUPS))
    own_id = _quoted(F.when(grouped, group_id(c("path"))).otherwise(article_id(c("path"))))
    gone = F.when(c("revogado") & c("kind").isin("Artigo", "Paragrafo"), ' situacao="revogado"').otherwise("")
    body = F.concat(F.lit("<p>"), _escaped(c("texto")), F.lit("</p>"))
    body = F.when(grouped, "").when(c("kind") == "Artigo", F.concat(F.lit('<Caput id="'), own_id, F.lit('_cpt">'), body)).otherwise(body)
    piece = F.concat(F.lit("<"), c("kind"), F.lit(' id="'), own_id, F.lit('"'), gone, F.lit("><Rotulo>"), _escaped(_label(c("path"), c("kind"), c("texto"))), F.lit("</Rotulo>"), body, closing)
    return met.select("doc", "place", piece.alias("piece"))


def documents(docs: DataFrame) -> DataFrame:
    """docs (lei_id, xml) -> lei_id, document (empty for the norm's own, else
    the annex's path), xml. Norms that share an id stay apart."""
    from normalake.sources.tables import stored

    c = F.col
    rows = stored(nodes(docs))
    urn = F.coalesce("urn", F.lit(FALLBACK_URN))
    identity = lambda x: F.concat(F.lit('<LexML><Metadado><Identificacao URN="'), _quoted(x), F.lit('"/></Metadado>'))
    path = F.element_at("paths", 1)
    top = rows.where(F.size("paths") == 1).withColumn("path", path).withColumn("at", F.element_at("places", 1))
    annex = F.startswith("path", F.lit("anexo-"))
    text = _escaped(c("texto"))
    opening = [F.min_by(F.when(c("path") == "preambulo", F.concat(F.lit("<p>"), text, F.lit("</p>"))).otherwise(text), F.when(c("path") == p, c("at"))).alias(f"_{i}") for i, (p, _, _) in enumerate(OPENING)]
    links = F.sort_array(F.collect_list(F.when(annex, F.struct("at", F.concat(F.lit('<ReferenciaAnexo AlvoURN="'), _quoted(F.concat(urn, F.lit("!"), "path")), F.lit('"/>')).alias("x")))))
    heads = top.groupBy("doc", "lei_id", "urn").agg(*opening, F.array_join(F.transform(links, lambda x: x["x"]), "").alias("annexes"))
    first = [F.coalesce(F.concat(F.lit(f'<{name} id="{key}">'), c(f"_{i}"), F.lit(f"</{name}>")), F.lit("")) for i, (_, name, key) in enumerate(OPENING)]
    initial = F.concat(*first)
    pieces = _pieces(rows).groupBy("doc").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "piece"))), lambda x: x["piece"]), "").alias("body"))
    whole = heads.join(pieces, "doc", "left")
    annexes = F.when(c("annexes") != "", F.concat(F.lit("<Anexos>"), "annexes", F.lit("</Anexos>"))).otherwise("")
    start = F.when(initial != "", F.concat(F.lit("<ParteInicial>"), initial, F.lit("</ParteInicial>"))).otherwise("")
    xml = F.concat(identity(urn), F.lit("<Norma>"), start, F.lit("<Articulacao>"), F.coalesce("body", F.lit("")), F.lit("</Articulacao>"), annexes, F.lit("</Norma></LexML>"))
    p = _quoted(c("path"))
    alone = F.concat(identity(F.concat(urn, F.lit("!"), "path")), F.lit('<Anexo><DocumentoGenerico id="doc-'), p, F.lit('"><PartePrincipal id="pp-'), p, F.lit('"><p id="p-'), p, F.lit('">'), text, F.lit("</p></PartePrincipal></DocumentoGenerico></Anexo></LexML>"))
    return whole.select("lei_id", F.lit("").alias("document"), xml.alias("xml")).union(top.where(annex).select("lei_id", "path", alone))
