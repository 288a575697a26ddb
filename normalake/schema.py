"""Schemas and fixed vocabularies of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

_D, _S, _I, _B = T.DateType(), T.StringType(), T.IntegerType(), T.BooleanType()

#: The flat table of versions, in its contractual order.
VERSIONS = T.StructType(
    [T.StructField(name, kind) for name, kind in (
        ("lei_id", _S), ("ente", _S), ("tipo_lei", _S), ("numero_lei", _S), ("ano_lei", _I), ("data_publicacao", _D), ("urn_lex_lei", _S), ("vigente_em", _D),
        ("lei_revogada", _B), ("lei_revogada_em", _D), ("lei_revogada_por", _S), ("lei_revogada_tipo", _S),
        ("dispositivo_path", _S), ("dispositivo_tipo", _S), ("dispositivo_ordem", _I), ("dispositivo_parent_path", _S),
        ("dispositivo_revogado", _B), ("dispositivo_revogado_em", _D), ("dispositivo_revogado_por", _S), ("dispositivo_revogado_tipo", _S), ("urn_dispositivo", _S),
        ("versao_id", _S), ("em", _D), ("ate", _D), ("alterado_por", _S), ("inicio_tipo", _S), ("texto", _S), ("texto_normalizado", _S),
        ("fontes", _S), ("num_fontes", _I), ("tem_divergencia", _B), ("hash_texto", _S), ("quality", _S),
    )]
)

#: What an export holds: all but quality.
EXPORT_COLUMNS = [f.name for f in VERSIONS if f.name != "quality"]

FONTES = T.ArrayType(T.StructType([T.StructField("ia_id", _S), T.StructField("diverge", _B), T.StructField("texto_divergente", _S)]))

_T = T.TimestampType()


def _strings(names: str, **other) -> T.StructType:
    return T.StructType([T.StructField(n, other.get(n, _S)) for n in names.split()])


LAWS = _strings("id titulo numero ano data_publicacao tipo_lei ente texto_completo texto_normalizado metadados url_original hash_conteudo created_at updated_at", ano=_I, data_publicacao=_D, created_at=_T, updated_at=_T)
LEDGER = _strings("url ente fonte tipo_documento chave status data_descoberta ultima_tentativa wayback_snapshot", data_descoberta=_T, ultima_tentativa=_T)
CAPTURES = _strings("tipo numero rendicao formato uuid5 sha256 captured_at source")

# Path tokens and the kinds of provision they mean.
NORMATIVE_TOKENS = {
    r"art-\d+(?:-[a-z])?": "artigo",
    r"par-(?:\d+|unico)": "paragrafo",
    r"inc-\d+": "inciso",
    r"ali-[a-z]": "alinea",
    r"item-\d+": "item",
    r"anexo-\d+": "anexo",
    r"disp-transitoria-\d+": "disposicao-transitoria",
    r"disp-final-\d+": "disposicao-final",
}
ORGANISING_TOKENS = {
    r"liv-\d+": "livro",
    r"parte-\d+": "parte",
    r"tit-\d+": "titulo",
    r"cap-\d+": "capitulo",
    r"sec-\d+": "secao",
    r"subsec-\d+": "subsecao",
}
WHOLE_PATHS = {"titulo-lei": "titulo-lei", "ementa": "ementa", "preambulo": "preambulo"}

# Enumerations of the canonical document.
START_KINDS = ("data-publicacao", "texto-lei-alteradora", "vacatio-legis", "consolidacao", "inferencia-llm", "decisao-judicial")
REVOCATION_KINDS = ("expressa", "tacita", "caducidade", "inconstitucionalidade", "nao-recepcao")

# Jurisdictions.
STATES = {
    "ac": "Acre", "al": "Alagoas", "am": "Amazonas", "ap": "Amapá", "ba": "Bahia", "ce": "Ceará", "df": "Distrito Federal",
    "es": "Espírito Santo", "go": "Goiás", "ma": "Maranhão", "mg": "Minas Gerais", "ms": "Mato Grosso do Sul", "mt": "Mato Grosso",
    "pa": "Pará", "pb": "Paraíba", "pe": "Pernambuco", "pi": "Piauí", "pr": "Paraná", "rj": "Rio de Janeiro", "rn": "Rio Grande do Norte",
    "ro": "Rondônia", "rr": "Roraima", "rs": "Rio Grande do Sul", "sc": "Santa Catarina", "se": "Sergipe", "sp": "São Paulo", "to": "Tocantins",
}
