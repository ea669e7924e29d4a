"""The twelve literal dimensions.

Fixed values: codes and descriptions of the admission-record code lists.
They must equal the source system's so the fact's codes resolve; stated in
their natural order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.sources.literal import literal_table

# --- fixed values: (table, schema, primary key, rows) ---
STATIC_DIMENSIONS: list[tuple[str, str, str, list[tuple]]] = [
    ("dim_espec", "cod bigint, espec string", "cod", [
        (1, "Clínica médica"),
        (2, "Cirurgia"),
        (3, "Obstetrícia"),
        (4, "Pediatria"),
        (5, "Psiquiatria"),
        (6, "Tisiologia"),
        (7, "Reabilitação"),
        (8, "Dermatologia sanitária"),
        (9, "Hanseníase"),
        (10, "Outras especialidades"),
        (12, "Cirurgia pediátrica"),
        (13, "Clínica pediátrica"),
        (14, "Hospital-dia"),
        (87, "Internação domiciliar"),
    ]),
    ("dim_ident", "cod bigint, descricao string", "cod", [
        (1, "AIH normal"),
        (3, "AIH de continuação"),
        (5, "AIH de longa permanência"),
    ]),
    ("dim_sexo", "cod bigint, descricao string", "cod", [
        (1, "Masculino"),
        (3, "Feminino"),
    ]),
    ("dim_marca_uti", "seq bigint, desc string, cod bigint", "cod", [
        (1, "Não utilizou UTI", 0),
        (2, "Unidade intermediária", 64),
        (3, "Unidade intermediária neonatal", 65),
        (4, "UTI I", 74),
        (5, "UTI Adulto II", 75),
        (6, "UTI Adulto III", 76),
        (7, "UTI Infantil I", 77),
        (8, "UTI Infantil II", 78),
        (9, "UTI Infantil III", 79),
        (10, "UTI Neonatal I", 80),
        (11, "UTI Neonatal II", 81),
        (12, "UTI Neonatal III", 82),
        (13, "UTI Queimados", 83),
        (14, "UTI Doador", 99),
    ]),
    ("dim_cobranca", "cod bigint, descricao string", "cod", [
        (11, "Serviços hospitalares"),
        (12, "Serviços profissionais"),
        (14, "Serviços hospitalares – complementar"),
        (15, "Serviços profissionais – complementar"),
        (16, "Serviços auxiliares"),
        (18, "SADT (Serviços de apoio diagnóstico e terapêutico)"),
        (19, "Outros serviços"),
        (21, "Diárias"),
        (22, "Taxas"),
        (23, "Materiais"),
        (24, "Medicamentos"),
        (25, "Órteses e próteses"),
        (26, "Sangue e hemoderivados"),
        (27, "Nutrição"),
        (28, "Gases medicinais"),
        (31, "UTI – diária"),
        (32, "UTI – taxa"),
        (41, "Transplantes"),
        (42, "Procedimentos especiais"),
        (43, "Terapias especiais"),
        (51, "Pacotes de procedimentos"),
        (61, "Internação domiciliar"),
        (62, "Atenção domiciliar – serviços"),
        (63, "Atenção domiciliar – materiais"),
        (64, "Atenção domiciliar – medicamentos"),
        (65, "Atenção domiciliar – equipamentos"),
        (66, "Atenção domiciliar – nutrição"),
        (67, "Atenção domiciliar – gases"),
    ]),
    ("dim_natjur", "cod bigint, descricao string", "cod", [
        (1015, "Administração pública direta"),
        (1023, "Autarquia"),
        (1031, "Fundação pública"),
        (1040, "Empresa pública"),
        (1058, "Sociedade de economia mista"),
        (1066, "Consórcio público"),
        (1074, "Fundação privada"),
        (2011, "Empresa privada"),
        (2020, "Sociedade empresária limitada"),
        (2038, "Sociedade anônima"),
        (2046, "Cooperativa"),
        (2054, "Entidade filantrópica"),
        (2062, "Organização social"),
        (2070, "Organização da sociedade civil"),
    ]),
    ("dim_gestao", "cod bigint, descricao string", "cod", [
        (1, "Gestão Municipal"),
        (2, "Gestão Estadual"),
    ]),
    ("dim_idade", "cod bigint, descricao string", "cod", [
        (2, "Dias"),
        (3, "Meses"),
        (4, "Anos"),
        (5, "Idade ignorada"),
    ]),
    ("dim_instrucao", "cod bigint, descricao string", "cod", [
        (0, "Ignorado / não informado"),
        (1, "Nenhuma escolaridade"),
        (2, "Ensino fundamental"),
        (3, "Ensino médio"),
        (4, "Ensino superior"),
    ]),
    ("dim_complex", "cod bigint, descricao string", "cod", [
        (1, "Atenção básica"),
        (2, "Média complexidade"),
        (3, "Alta complexidade"),
    ]),
    ("dim_financ", "cod bigint, descricao string", "cod", [
        (1, "Atenção básica"),
        (2, "Média complexidade"),
        (3, "Alta complexidade"),
        (4, "Fundo de ações estratégicas e compensação (FAEC)"),
        (5, "Incentivos"),
        (6, "Média e alta complexidade (MAC)"),
        (7, "Assistência farmacêutica"),
        (8, "Vigilância em saúde"),
    ]),
    ("dim_raca_cor", "cod bigint, descricao string", "cod", [
        (0, "Ignorado"),
        (1, "Branca"),
        (2, "Preta"),
        (3, "Parda"),
        (4, "Amarela"),
        (5, "Indígena"),
    ]),
]

STATIC_PRIMARY_KEYS = {name: pk for name, _, pk, _ in STATIC_DIMENSIONS}


def static_dimension(spark: SparkSession, name: str) -> DataFrame:
    for table, schema, _, rows in STATIC_DIMENSIONS:
        if table == name:
            return literal_table(spark, rows, schema)
    raise KeyError(name)


def static_dimensions(spark: SparkSession) -> dict[str, DataFrame]:
    return {table: literal_table(spark, rows, schema) for table, schema, _, rows in STATIC_DIMENSIONS}


def static_codes(spark: SparkSession) -> DataFrame:
    """All twelve lists in one long table ``(table_name, cod, descricao)``."""
    frames = []
    for table, df in static_dimensions(spark).items():
        text = [c for c in df.columns if c not in ("cod", "seq")][0]
        frames.append(df.select(F.lit(table).alias("table_name"), F.col("cod"),
                                F.col(f"`{text}`").alias("descricao")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
