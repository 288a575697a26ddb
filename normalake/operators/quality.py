"""Data-quality rules as tables of violations (file, rule, message)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from normalake.functions import law

#: place, source and key, after an optional prefix.
RAW_ID = r"^(?:[a-z]+-)?raw-[a-z][a-z0-9-]*-[a-z]+-[a-z0-9-]+$"
#: A parsed document's canonical id: place, kind, number of five digits at least, year.
PARSED_ID = r"^[a-z]+-([a-z][a-z0-9-]*)-([a-z]+)-(\d{5,})-(\d{4})$"


def _out(df: DataFrame, rule: str, message: Column) -> DataFrame:
    return df.select(F.col("lei_id").alias("file"), F.lit(rule).alias("rule"), message.alias("message"))


def divergence_has_text(df: DataFrame) -> DataFrame:
    """A source diverges just if it carries a text."""
    f = df.select("lei_id", "versao_id", F.explode(law.sources(F.col("fontes"))).alias("f"))
    bad = F.coalesce("f.diverge", F.lit(False)) != (F.coalesce("f.texto_divergente", F.lit("")) != "")
    return _out(f.where(bad), "VAL1", F.concat("versao_id", F.lit(" "), "f.ia_id"))


def total_excludes_partial(df: DataFrame) -> DataFrame:
    return _out(df.where("lei_revogada AND dispositivo_revogado").select("lei_id", "dispositivo_path").distinct(), "VAL2", F.col("dispositivo_path"))


def revocation_has_author(df: DataFrame) -> DataFrame:
    """Expiry names no author, every other kind of revocation does, of a
    provision or of the whole law; one without a kind is not judged."""

    def bad(kind: str, author: str) -> Column:
        return (F.coalesce(kind, F.lit("")) != "") & ((F.col(kind) == "caducidade") == F.col(author).isNotNull())

    one = df.where(F.col("dispositivo_revogado") & bad("dispositivo_revogado_tipo", "dispositivo_revogado_por")).select("lei_id", "dispositivo_path")
    whole = df.where(F.col("lei_revogada") & bad("lei_revogada_tipo", "lei_revogada_por")).select("lei_id", F.lit("lei").alias("dispositivo_path"))
    return _out(one.union(whole).distinct(), "VAL3", F.col("dispositivo_path"))


def paths(df: DataFrame) -> DataFrame:
    """Paths of known tokens that continue their parent's, class by class."""
    # what a path is does not depend on the law: each pair of paths is judged once
    p = df.select("dispositivo_path", "dispositivo_parent_path").distinct()
    organising = lambda k: k.isin("livro", "parte", "titulo", "capitulo", "secao", "subsecao")
    kinds = p.select(F.col("dispositivo_path").alias("_of")).union(p.select("dispositivo_parent_path")).distinct().withColumn("_kind", law.path_kind(F.col("_of")))
    for name, of in (("_own", "dispositivo_path"), ("_above", "dispositivo_parent_path")):
        p = p.join(kinds.withColumnRenamed("_kind", name), F.col(of) == F.col("_of"), "left").drop("_of")
    kind, above = F.col("_own"), F.col("_above")
    unknown = kind.isNull()
    same = organising(kind) == organising(above)
    unlike = same & ~F.startswith("dispositivo_path", F.concat("dispositivo_parent_path", F.lit("-")))
    nested = organising(kind) & ~organising(above)
    why = F.when(unknown, "unknown path").when(F.coalesce(nested, F.lit(False)), "organising under normative").when(F.coalesce(unlike, F.lit(False)), "not under its parent")
    broken = p.withColumn("why", why).where("why IS NOT NULL").select(F.col("dispositivo_path").alias("_p"), F.col("dispositivo_parent_path").alias("_a"), "why")
    met = F.col("dispositivo_path").eqNullSafe(F.col("_p")) & F.col("dispositivo_parent_path").eqNullSafe(F.col("_a"))
    found = df.select("lei_id", "dispositivo_path", "dispositivo_parent_path").join(broken, met).select("lei_id", "dispositivo_path", "dispositivo_parent_path", "why").distinct()
    return _out(found, "VAL4", F.concat("dispositivo_path", F.lit(": "), "why"))


def urns(df: DataFrame) -> DataFrame:
    one = df.select("lei_id", "urn_lex_lei").distinct().where("urn_lex_lei IS NOT NULL")
    broken = _out(one.where(law.urn_part(F.col("urn_lex_lei"), "tipo").isNull()), "VAL5", F.col("urn_lex_lei"))
    # a number that is left with five digits or more may have the zero of its own
    padded = _out(one.where(law.urn_part(F.col("urn_lex_lei"), "numero").rlike("^0+[0-9]{0,4}$")), "VAL14", F.col("urn_lex_lei"))
    return broken.union(padded)


def starts_declared(df: DataFrame) -> DataFrame:
    """A start other than publication needs an amending law or a declared kind."""
    bad = (F.col("em") != F.col("data_publicacao")) & F.col("alterado_por").isNull() & (F.col("inicio_tipo") == "data-publicacao")
    return _out(df.where(bad), "VAL6", F.col("versao_id"))


def increasing(df: DataFrame, order: str = "pos") -> DataFrame:
    w = Window.partitionBy("lei_id", "dispositivo_path").orderBy(order)
    return _out(df.withColumn("_b", F.lag("em").over(w)).where("em <= _b"), "VAL7", F.concat_ws("#", "dispositivo_path", F.col("em").cast("string")))


def source_ids(df: DataFrame) -> DataFrame:
    f = df.select("lei_id", F.explode(law.sources(F.col("fontes"))).alias("f")).select("lei_id", "f.ia_id").distinct()
    return _out(f.where(~F.coalesce("ia_id", F.lit("")).rlike(RAW_ID)), "VAL8", F.coalesce("ia_id", F.lit("")))


def urn_matches_id(df: DataFrame) -> DataFrame:
    """The URN's kind, year and number against those of a canonical id, one row
    for each that differs or is missing; a canonical id needs a URN. Other ids
    are not judged."""
    one = df.select("lei_id", "urn_lex_lei").distinct().where(F.col("lei_id").rlike(PARSED_ID))
    of = lambda k: F.regexp_extract("lei_id", PARSED_ID, k)
    part = lambda name: law.urn_part(F.col("urn_lex_lei"), name)
    bare = lambda n: F.regexp_replace(n, "^0+(?=.)", "")
    sound = part("tipo").isNotNull()  # a URN that cannot be taken apart is VAL5
    differs = {"tipo": sound & (part("tipo") != of(2)), "ano": sound & (F.substring(part("data"), 1, 4) != of(4)), "numero": sound & ~F.coalesce(bare(part("numero")) == bare(of(3)), F.lit(False))}
    why = F.array_compact(F.array(F.when(F.col("urn_lex_lei").isNull(), "urn"), *[F.when(bad, k) for k, bad in differs.items()]))
    return _out(one.select("lei_id", F.explode(why).alias("why")), "VAL10", F.col("why"))


def unique_paths(tree: DataFrame) -> DataFrame:
    """tree (lei_id, dispositivo_path), one row a provision element."""
    many = tree.groupBy("lei_id", "dispositivo_path").agg(F.count("*").alias("n")).where("n > 1")
    return _out(many, "VAL13", F.col("dispositivo_path"))


def one_source(df: DataFrame) -> DataFrame:
    """Exactly one source for each wording."""
    return _out(df.where(F.size(law.sources(F.col("fontes"))) != 1), "VAL17", F.col("versao_id"))


def parsed_fields(df: DataFrame) -> DataFrame:
    bad = (F.coalesce("tipo_lei", F.lit("")) == "") | ~F.coalesce("numero_lei", F.lit("")).rlike(r"^\d+$") | F.col("ano_lei").isNull()
    return _out(df.where(bad).select("lei_id").distinct(), "VAL19", F.lit("tipo, numero, ano"))


def repeated(df: DataFrame, *key: str) -> DataFrame:
    """Keys of more than one row, with their number n."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """The same rows; fails if a key repeats."""
    many = repeated(df, key).limit(1).collect()
    if many:
        raise ValueError(f"Duplicate {key} detected: {many[0][key]}")
    return df


ALL = (divergence_has_text, total_excludes_partial, revocation_has_author, paths, urns, starts_declared, source_ids, urn_matches_id, one_source, parsed_fields)


def violations(df: DataFrame) -> DataFrame:
    """All rules over one versions table."""
    return reduce(lambda a, b: a.union(b), [f(df) for f in ALL])


def summary(found: DataFrame) -> DataFrame:
    """Totals, and the exit code: 2 if a document cannot be parsed (VAL0), 1 for
    any other violation, else 0."""
    code = F.when(F.coalesce(F.bool_or(F.col("rule") == "VAL0"), F.lit(False)), 2).when(F.count("*") > 0, 1).otherwise(0)
    return found.agg(F.count("*").alias("total"), F.countDistinct("file").alias("files"), code.alias("exit_code"))
