"""Identifiers, buckets, file names, titles and URLs as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from normalake.functions.text import fold, strip

BUCKET = 1000
# Words in titles, most specific first; file-name prefixes; key
# heads that carry no identity; document types by file-name ending.
TITLE_KINDS = (
    ("lei complementar", "lc"), ("decreto-lei", "decreto-lei"), ("decreto lei", "decreto-lei"), ("emenda constitucional", "emenda-constitucional"),
    ("medida provisoria", "medida-provisoria"), ("decreto", "decreto"), ("resolucao", "resolucao"), ("portaria", "portaria"), ("lei", "lei"),
)
FILE_PREFIXES = {"PORT": "portaria", "RES": "resolucao", "DEC": "decreto", "LC": "lc", "EC": "ec", "DL": "decreto-lei", "L": "lei", "D": "decreto"}
NOT_IDENTIFYING = ("coddoc", "documento", "fallback", "seq")
ENDINGS = {"_djvu.txt": "pdf", ".pdf": "pdf", ".html": "html", ".docx": "docx"}


def _first(pattern: str, c: Column, group: int = 1) -> Column:
    """The group of the first match, or null."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def _mapped(key: Column, values: dict) -> Column:
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.create_map(*pairs)[key]


def title_identity(title: Column) -> Column:
    """struct(tipo, numero) from a title, or null: the number must stand after
    a real ordinal sign or point and be positive."""
    t = fold(F.coalesce(title, F.lit("")))
    kind = F.coalesce(*[F.when(F.instr(t, needle) > 0, F.lit(name)) for needle, name in TITLE_KINDS])
    digits = F.regexp_replace(_first(r"\bn[º°o.\s]*[º°.]\s*(\d[\d.]*)", t), r"\.", "")
    number = digits.try_cast("bigint")
    return F.when(kind.isNotNull() & (number > 0), F.struct(kind.alias("tipo"), number.alias("numero")))


def file_identity(name: Column) -> Column:
    """struct(tipo, chave) from a file name such as L5120.pdf, or null, also
    for a number beyond a long."""
    stem = F.upper(strip(F.regexp_replace(name, r"\.[^.]*$", "")))
    pattern = r"^(PORT|RES|DEC|LC|EC|DL|L|D)(\d+)$"
    # a longer prefix that fits decides, whether digits follow or not
    kind = _mapped(_first(pattern, stem), FILE_PREFIXES)
    number = _first(pattern, stem, 2).try_cast("bigint")
    return F.when(kind.isNotNull() & number.isNotNull(), F.struct(kind.alias("tipo"), F.concat(kind, F.lit("-"), F.format_string("%05d", number)).alias("chave")))


def key_identity(key: Column) -> Column:
    """struct(tipo, numero) from a key such as lei-05120, or null, also for a
    number beyond a long."""
    k = F.lower(strip(key))
    pattern = r"^([a-z][a-z0-9-]*)-(\d+)$"
    ok = k.rlike(pattern) & ~F.element_at(F.split(k, "-"), 1).isin(*NOT_IDENTIFYING)
    number = F.regexp_extract(k, pattern, 2).try_cast("bigint")
    return F.when(ok & number.isNotNull(), F.struct(F.regexp_extract(k, pattern, 1).alias("tipo"), number.alias("numero")))


def raw_id_parts(raw_id: Column, slugs: list[str], prefix: str = "raw") -> Column:
    """struct(ente, fonte, chave) of prefix-ente-fonte-chave. The longest slug
    that fits decides; there is no second try with a shorter one."""
    rest = F.when(F.startswith(raw_id, F.lit(prefix + "-")), F.substring(raw_id, len(prefix) + 2, 1_000_000))
    ordered = sorted(slugs, key=lambda s: (-len(s), s))
    slug = F.coalesce(*[F.when(F.startswith(rest, F.lit(s + "-")), F.lit(s)) for s in ordered])
    tail = rest.substr(F.length(slug) + 2, F.length(rest))
    ok = slug.isNotNull() & tail.rlike("^[^-]+-.+$")
    return F.when(ok, F.struct(slug.alias("ente"), F.regexp_extract(tail, "^([^-]+)-(.+)$", 1).alias("fonte"), F.regexp_extract(tail, "^([^-]+)-(.+)$", 2).alias("chave")))


def bucket_start(n: Column, size: int = BUCKET) -> Column:
    return F.when(n > 0, F.floor((n - 1) / size) * size + 1).otherwise(F.lit(1)).cast("bigint")


def bucket_end(n: Column, size: int = BUCKET) -> Column:
    return bucket_start(n, size) + (size - 1)


def bucket_item(ente: Column, fonte: Column, kind: Column, n: Column, prefix: str = "norma") -> Column:
    return F.lower(F.format_string("%s_%s_%s_%s_%04d-%04d", F.lit(prefix), ente, fonte, kind, bucket_start(n), bucket_end(n)))


def holding_item(ente: Column, fonte: Column, prefix: str = "norma") -> Column:
    return F.lower(F.concat_ws("_", F.lit(prefix), ente, fonte, F.lit("unidentified")))


def safe_name(c: Column) -> Column:
    return F.regexp_replace(c, r"[^a-zA-Z0-9_-]", "")


def safe_path(c: Column) -> Column:
    return F.regexp_replace(c, r"[^a-z0-9-]", "_")


def uuid5(name: Column) -> Column:
    """UUID version 5 in the DNS name space, from SHA-1 of its bytes."""
    space = F.unhex(F.lit("6ba7b8109dad11d180b400c04fd430c8"))
    h = F.sha1(F.concat(space, name.cast("binary")))
    variant = F.lower(F.hex((F.conv(F.substring(h, 17, 1), 16, 10).cast("bigint").bitwiseAND(F.lit(3)) + 8)))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def content_name(sha: Column) -> Column:
    """The first 8 characters of the content's UUID."""
    return F.substring(uuid5(sha), 1, 8)


def bundle_id(ente: Column, fonte: Column, day: Column, prefix: str = "bundle") -> Column:
    """A weekly bundle by ISO year and week."""
    return F.format_string("%s-%s-%s-%dW%02d", F.lit(prefix), ente, fonte, F.extract(F.lit("YEAROFWEEK"), day), F.weekofyear(day))


def snapshot_stamp(url: Column) -> Column:
    return _first(r"/web/(\d{14})", url)


def raw_snapshot(url: Column) -> Column:
    """The capture's bytes without the archive's banner."""
    return F.regexp_replace(url, r"(/web/\d{14})/", "$1id_/")


def flip_scheme(url: Column) -> Column:
    return F.when(F.startswith(url, F.lit("https://")), F.regexp_replace(url, "^https://", "http://")).when(F.startswith(url, F.lit("http://")), F.regexp_replace(url, "^http://", "https://")).otherwise(url)


def without_scheme(url: Column) -> Column:
    return F.regexp_replace(url, "^https?://", "")


def join_url(base: Column, link: Column) -> Column:
    """Absolute, scheme-relative, root-relative and relative links."""
    root = F.regexp_extract(base, "^([a-z][a-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, "[?#].*$", ""), "(://[^/]*.*)/[^/]*$", "$1/")
    return (
        F.when(link.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), link)
        .when(F.startswith(link, F.lit("//")), F.concat(F.regexp_extract(base, "^([a-z][a-z0-9+.-]*:)", 1), link))
        .when(F.startswith(link, F.lit("/")), F.concat(root, link))
        .otherwise(F.concat(folder, link))
    )


def item_of_url(url: Column, fallback: Column) -> Column:
    """The archive item in a details or download URL, else raw-fallback."""
    return F.coalesce(_first(r"/(?:details|download)/([^/?#]+)", url), F.concat(F.lit("raw-"), fallback))


def meta_url(url: Column) -> Column:
    """The sidecar beside a dataset's Parquet file; null on other hosts."""
    item = _first(r"^https?://[^/]*archive\.org/download/([^/]+)/[^/]+\.parquet$", url)
    return F.when(item.isNotNull(), F.concat(F.lit("https://archive.org/download/"), item, F.lit("/dataset_meta.json")))


def year_in_title(title: Column) -> Column:
    return _first(r"\b((?:19|20)\d{2})\b", title).cast("int")


def last_segment(key: Column) -> Column:
    return F.element_at(F.split(key, "-"), -1)


def parsed_id(ente: Column, kind: Column, number: Column, year: Column, prefix: str = "norma") -> Column:
    """prefix-ente-tipo-number-year; null unless the number is digits."""
    return F.when(number.rlike(r"^\d+$") & year.isNotNull(), F.format_string("%s-%s-%s-%05d-%d", F.lit(prefix), ente, kind, number.try_cast("bigint"), year))


def file_name(kind: Column, key: Column) -> Column:
    return F.lower(F.concat(kind, F.lit("-"), last_segment(key), F.lit(".pdf")))


def year_segment(year: Column, first: int = 2003, width: int = 4) -> Column:
    """The four-year range a year from 2003 falls in, else null."""
    low = F.floor((year - first) / width).cast("int") * width + first
    return F.when(year >= first, F.concat(low.cast("string"), F.lit("-"), (low + width - 1).cast("string")))
