"""A hand-written feed with the awkward cases, as texts, for both doors."""

from __future__ import annotations

import json
from pathlib import Path

from starfold.schema import FEED

PLAIN = {
    "document_id": "d0",
    "paciente_id": "p0",
    "paciente_idade": "30",
    "paciente_dataNascimento": "1991-02-03",
    "paciente_enumSexoBiologico": "F",
    "paciente_racaCor_codigo": "1",
    "paciente_racaCor_valor": "BRANCA",
    "paciente_endereco_coIbgeMunicipio": "355030",
    "paciente_endereco_coPais": "10",
    "paciente_endereco_nmMunicipio": "SAO PAULO",
    "paciente_endereco_nmPais": "BRASIL",
    "paciente_endereco_uf": "SP",
    "paciente_endereco_cep": "01000",
    "paciente_nacionalidade_enumNacionalidade": "B",
    "estabelecimento_valor": "100",
    "estabelecimento_razaoSocial": "PREFEITURA",
    "estalecimento_noFantasia": "UBS CENTRO",
    "estabelecimento_municipio_codigo": "355030",
    "estabelecimento_municipio_nome": "SAO PAULO",
    "estabelecimento_uf": "SP",
    "vacina_grupoAtendimento_codigo": "2",
    "vacina_grupoAtendimento_nome": "Faixa",
    "vacina_categoria_codigo": "5",
    "vacina_categoria_nome": "Idade",
    "vacina_lote": "L1",
    "vacina_fabricante_nome": "BUTANTAN",
    "vacina_fabricante_referencia": "ref",
    "vacina_dataAplicacao": "2021-05-06",
    "vacina_descricao_dose": "1a Dose",
    "vacina_codigo": "86",
    "vacina_nome": "Vacina",
    "sistema_origem": "SI",
}


def row(document_id: str, **changes: str | None) -> dict[str, str | None]:
    return {**PLAIN, "document_id": document_id, **changes}


# Name of the case -> the row as it arrives.
CASES = {
    "spaces": row("c01", vacina_nome="  Vacina  ", sistema_origem="\tSI\t", vacina_fabricante_referencia=" r "),
    "accents": row("c02", estabelecimento_razaoSocial="São João", estalecimento_noFantasia="Bebê à ñ Ação ẞ"),
    "tokens": row(
        "c03", paciente_endereco_nmPais="None", paciente_endereco_uf="", paciente_endereco_cep=" N/A ",
        vacina_categoria_nome="Pendente Identificação", sistema_origem="none",
    ),
    "lot": row("c04", vacina_lote=" ab-12c "),
    "date iso": row("c05", vacina_dataAplicacao="2021-05-06"),
    "date stamp": row("c06", vacina_dataAplicacao="2021-05-07T00:00:00.000Z"),
    "date digits": row("c07", vacina_dataAplicacao="20210508"),
    "date short": row("c08", vacina_dataAplicacao="06/05"),
    "date empty": row("c09", vacina_dataAplicacao=""),
    "date missing": row("c10", vacina_dataAplicacao=None),
    "bad int": row("c11", paciente_idade="12a"),
    "bad birth date": row("c12", paciente_dataNascimento="1991-13-45"),
}


def write_csv(rows: list[dict], folder: Path, name: str = "feed.csv") -> None:
    folder.mkdir(parents=True, exist_ok=True)
    lines = [";".join(FEED.names)]
    lines += [";".join("" if r[n] is None else r[n] for n in FEED.names) for r in rows]
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def write_page(rows: list[dict], folder: Path, name: str = "page_0.json", indent: int | None = None) -> None:
    """One array of hits per file, ages and codes as numbers where they are numbers."""
    folder.mkdir(parents=True, exist_ok=True)
    numbers = {f.name for f in FEED if f.dataType.typeName() == "integer"}

    def value(name: str, text: str | None):
        return int(text) if name in numbers and text and text.isdigit() else text

    hits = [
        {"_source": {n: value(n, r[n]) for n in FEED.names} | {"extra": 1}, "sort": [1620259200000, r["document_id"]]}
        for r in rows
    ]
    (folder / name).write_text(json.dumps(hits, ensure_ascii=False, indent=indent), encoding="utf-8")


def silver(spark, rows: list[dict]):
    """Rows typed as silver, without going through files."""
    from starfold.operators.clean import clean, conform

    texts = spark.createDataFrame([tuple(r[n] for n in FEED.names) for r in rows], [f"{n}" for n in FEED.names])
    return clean(conform(texts))
