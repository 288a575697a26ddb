"""Provision paths, URNs, dates and labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from normalake.functions.identity import _mapped
from normalake.schema import FONTES, NORMATIVE_TOKENS, ORGANISING_TOKENS, STATES, WHOLE_PATHS

_URN = r"^urn:lex:br((?:;[a-z][a-z0-9.]*)*):([a-z][a-z0-9.]*(?:;[a-z][a-z0-9.]*)*):([a-z][a-z0-9.]*):(\d{4}(?:-\d{2}-\d{2})?)(?:;([a-z0-9.\-]+))?((?:![a-z0-9._\-]+)*)$"
URN_PARTS = {"locais": 1, "autoridade": 2, "tipo": 3, "data": 4, "numero": 5, "paths": 6}
# Labels.
KIND_LABELS = {
    "lei": "Lei Ordinária", "lei.complementar": "Lei Complementar", "lei-complementar": "Lei Complementar", "lc": "Lei Complementar", "decreto": "Decreto",
    "decreto-lei": "Decreto-Lei", "decreto.lei": "Decreto-Lei", "medida.provisoria": "Medida Provisória", "emenda.constitucional": "Emenda Constitucional",
    "constituicao": "Constituição", "resolucao": "Resolução", "portaria": "Portaria",
}
PLACE_LABELS = {"ro": STATES["ro"], "sp": STATES["sp"], "federal": "Federal"}


def _alternatives(tokens: dict[str, str]) -> str:
    return "|".join(tokens)


def path_kind(path: Column) -> Column:
    """The last token's kind; null unless all tokens are of one class."""
    out = F.lit(None).cast("string")
    # titulo-lei may stand within a path, the other whole paths may not
    for tokens in ({**NORMATIVE_TOKENS, "titulo-lei": "titulo-lei"}, ORGANISING_TOKENS):
        every = _alternatives(tokens)
        whole = path.rlike(f"^(?:{every})(?:-(?:{every}))*$")
        last = F.coalesce(*[F.when(path.rlike(f"(?:^|-)(?:{t})$") & path.rlike(f"^(?:(?:{every})-)*(?:{t})$"), F.lit(k)) for t, k in tokens.items()])
        out = F.coalesce(out, F.when(whole, last))
    return F.coalesce(_mapped(path, WHOLE_PATHS), out)


def urn_part(urn: Column, part: str) -> Column:
    """A part of a law URN; null if the URN or the part isn't there."""
    return F.when(urn.rlike(_URN), F.nullif(F.regexp_extract(urn, _URN, URN_PARTS[part]), F.lit("")))


def parse_date(c: Column) -> Column:
    """An ISO day, a time zone after it ignored: 2020-01-02, 20200102, or by
    week, 2020-W01-4, 2020W014, 2020-W01 and 2020W01 (its Monday); null if it is
    none."""
    clean = F.regexp_replace(c, r"([+-]\d{2}:\d{2}|Z)$", "")
    week = r"^(\d{4})(?:-W(\d{2})(?:-([1-7]))?|W(\d{2})([1-7])?)$"
    part = lambda *ks: F.coalesce(*[F.nullif(F.regexp_extract(clean, week, k), F.lit("")) for k in ks]).try_cast("int")
    # the first week is the one with the fourth of January
    fourth = F.make_date(part(1), F.lit(1), F.lit(4))
    monday = F.date_add(F.date_sub(fourth, F.weekday(fourth)), (part(2, 4) - 1) * 7)
    last = F.make_date(part(1), F.lit(12), F.lit(28))
    exists = part(2, 4).between(1, F.weekofyear(last))
    by_week = F.when(exists, F.date_add(monday, F.coalesce(part(3, 5), F.lit(1)) - 1))
    return F.when(clean.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(clean, "yyyy-MM-dd")).when(clean.rlike(r"^\d{8}$"), F.try_to_date(clean, "yyyyMMdd")).when(clean.rlike(week), by_week)


def publication_date(urn: Column) -> Column:
    return F.when(F.length(urn_part(urn, "data")) == 10, parse_date(urn_part(urn, "data")))


def version_id(law: Column, path: Column, em: Column) -> Column:
    return F.concat(law, F.lit("#"), path, F.lit("#"), F.coalesce(em.cast("date").cast("string"), F.lit("unknown")))


def start_kind(declared: Column, has_start: Column, amended_by: Column) -> Column:
    return F.when(has_start, F.coalesce(declared, F.lit("data-publicacao"))).when(F.coalesce(amended_by, F.lit("")) != "", F.lit("texto-lei-alteradora")).otherwise(F.lit("data-publicacao"))


def is_true(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c)).isin("true", "1"), F.lit(False))


def kind_label(kind: Column) -> Column:
    spaced = F.regexp_replace(kind, "[._-]", " ")
    return F.when(F.coalesce(kind, F.lit("")) == "", F.lit("Norma")).otherwise(F.coalesce(_mapped(kind, KIND_LABELS), _title(spaced)))


def _title(c: Column) -> Column:
    """Each word's first letter in upper case; the rest as it is."""
    return F.array_join(F.transform(F.split(c, " ", -1), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), w.substr(F.lit(2), F.length(w)))), " ")


def place_label(place: Column) -> Column:
    return F.when(F.coalesce(place, F.lit("")) == "", F.lit("—")).otherwise(F.coalesce(_mapped(place, PLACE_LABELS), F.upper(place)))


def law_title(kind: Column, number: Column, year: Column) -> Column:
    n = F.when(F.coalesce(number, F.lit("")) != "", F.concat(F.lit("nº "), number)).otherwise(F.lit("s/nº"))
    return F.concat(kind_label(kind), F.lit(" "), n, F.coalesce(F.concat(F.lit("/"), year.cast("string")), F.lit("")))


_DIGITS = (("", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"), ("", "X", "XX", "XXX", "XL", "L", "LX", "LXX", "LXXX", "XC"), ("", "C", "CC", "CCC", "CD", "D", "DC", "DCC", "DCCC", "CM"), ("", "M", "MM", "MMM"))


def roman(n: Column) -> Column:
    """1 to 3999, else the number itself."""
    places = [F.element_at(F.array(*map(F.lit, _DIGITS[k])), (F.floor(n / 10**k) % (10 if k < 3 else 4)).cast("int") + 1) for k in (3, 2, 1, 0)]
    return F.when((n > 0) & (n < 4000), F.concat(*places)).otherwise(n.cast("string"))


def ordinal(n: Column) -> Column:
    return F.when(n.cast("int").between(1, 9), F.concat(n.cast("int").cast("string"), F.lit("º"))).otherwise(n.cast("string"))


def segments(path: Column) -> Column:
    """array of a path's tokens; what is no token stands by itself."""
    every = _alternatives({**NORMATIVE_TOKENS, **ORGANISING_TOKENS})
    return F.regexp_extract_all(path, F.lit(rf"(titulo-lei|ementa|preambulo|(?:{every})(?=-|$)|[^-]+)"), 1)


def _token_label(t: Column) -> Column:
    tail = F.element_at(F.split(t, "-"), 2)
    n = tail.try_cast("int")
    art = F.concat(F.lit("Art. "), ordinal(n), F.when(F.size(F.split(t, "-")) > 2, F.concat(F.lit("-"), F.upper(F.element_at(F.split(t, "-"), -1)))).otherwise(F.lit("")))
    return (
        F.when(t == "ementa", "Ementa").when(t == "preambulo", "Preâmbulo").when(t == "titulo-lei", "Título da lei")
        .when(t.rlike(r"^art-\d"), art)
        .when(t == "par-unico", "Parágrafo único")
        .when(t.rlike(r"^par-\d"), F.concat(F.lit("§ "), ordinal(n)))
        .when(t.rlike(r"^inc-\d"), roman(n))
        .when(t.rlike(r"^ali-[a-z]$"), F.concat(tail, F.lit(")")))
        .when(t.rlike(r"^item-\d"), F.concat(F.lit("item "), tail))
        .when(t.rlike(r"^disp-transitoria-\d"), F.concat(F.lit("Disposição Transitória "), F.element_at(F.split(t, "-"), 3)))
        .when(t.rlike(r"^disp-final-\d"), F.concat(F.lit("Disposição Final "), F.element_at(F.split(t, "-"), 3)))
        .when(t.rlike(r"^anexo-\d"), F.concat(F.lit("Anexo "), roman(n)))
        .when(t.rlike(r"^liv-\d"), F.concat(F.lit("Livro "), roman(n)))
        .when(t.rlike(r"^parte-\d"), F.concat(F.lit("Parte "), roman(n)))
        .when(t.rlike(r"^tit-\d"), F.concat(F.lit("Título "), roman(n)))
        .when(t.rlike(r"^cap-\d"), F.concat(F.lit("Capítulo "), roman(n)))
        .when(t.rlike(r"^sec-\d"), F.concat(F.lit("Seção "), roman(n)))
        .when(t.rlike(r"^subsec-\d"), F.concat(F.lit("Subseção "), roman(n)))
        .otherwise(t)
    )


def breadcrumb(path: Column) -> Column:
    return F.array_join(F.transform(segments(path), _token_label), " › ")


def short_label(path: Column) -> Column:
    return F.element_at(F.transform(segments(path), _token_label), -1)


def citation(kind: Column, number: Column, year: Column, path: Column) -> Column:
    """The title, and the breadcrumb but for the summary."""
    return F.concat_ws(". ", law_title(kind, number, year), F.when(path != "ementa", breadcrumb(path)))


def law_url(law: Column, base: str = "/") -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/lei?id="), F.url_encode(law))


def details_url(item: Column, base: str = "https://archive.org") -> Column:
    """The page of an archived item."""
    return F.concat(F.lit(f"{base}/details/"), F.url_encode(item))


def file_url(item: Column, file: str, base: str = "https://archive.org") -> Column:
    """A file of an archived item; law.xml is a law's document, parsed_meta.json
    the record of its parse."""
    return F.concat(F.lit(f"{base}/download/"), F.url_encode(item), F.lit(f"/{file}"))


def search_url(query: Column, base: str = "https://archive.org") -> Column:
    return F.concat(F.lit(f"{base}/search?query="), F.url_encode(query))


def coverage_label(place: Column) -> Column:
    """Where a place's law holds: its state's name in Brazil, else Brazil."""
    return F.coalesce(F.concat(_mapped(F.lower(place), STATES), F.lit(", Brazil")), F.lit("Brazil"))


def sources(c: Column) -> Column:
    """The JSON list of sources; anything else is an empty list."""
    return F.coalesce(F.from_json(c, FONTES), F.array().cast(FONTES))


def format_date(c: Column) -> Column:
    return F.coalesce(F.date_format(c, "dd/MM/yyyy"), F.lit("—"))


def iso_date(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def date_ms(c: Column) -> Column:
    """Milliseconds since 1970; null counts as 0."""
    return F.coalesce(F.unix_date(c).cast("bigint") * 86_400_000, F.lit(0).cast("bigint"))


def heading_level(depth: Column) -> Column:
    return F.least(F.lit(6), depth + 4)


def lexml_id(path: Column) -> Column:
    """A path's id in the exchange format: art-5-par-unico-inc-2 becomes
    art5_par1u_inc2; a letter after the article stays apart (art5-a), and what
    hangs on an article other than a paragraph hangs on its caput."""
    t = F.transform(segments(path), lambda x: F.regexp_replace(F.regexp_replace(F.regexp_replace(x, "^par-unico$", "par1u"), r"^([a-z]+(?:-[a-z]+)*)-(\d+)", "$1$2"), "^ali-([a-z])$", "ali$1"))
    joined = F.array_join(t, "_")
    return F.regexp_replace(joined, r"^(art\d+(?:-[a-z])?)_(inc|ali|item)", "$1_cpt_$2")
