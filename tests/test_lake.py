"""The whole load (ingest conversions, L4 -> catalog dims -> L2 -> L3) on a
constructed raw zone."""

import os

from lakeloom.operators.manifest import coverage_status, period_state_grid
from lakeloom.plans.lake import RAW_FOLDERS, convert_dbf, convert_fixed_width, load_lake
from lakeloom.sinks.targets import Target
from lakeloom.sources.dbf import dbf_fields, encode_dbf
from lakeloom.sources.fixed_width import MUNICIPALITY_LAYOUT, NATIONALITY_LAYOUT, STATE_LAYOUT
from lakeloom.spec import FACT_COLUMNS, FACT_FOREIGN_KEYS


def _lines(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(("\r\n".join(lines) + "\r\n").encode("latin-1"))


def _fact_row(**vals):
    return ",".join(str(vals.get(n, "")) for n, _ in FACT_COLUMNS)


def build_raw_zone(spark, tmp):
    src, raw = os.path.join(tmp, "src"), os.path.join(tmp, "raw")
    _lines(os.path.join(src, "cnv", "br_uf.cnv"), ["     11  11 Rondônia", "     35  35 São Paulo"])
    _lines(os.path.join(src, "cnv", "br_municip.cnv"),
           ["      1  110001 Alta Floresta D'Oeste", "      2  355030 São Paulo",
            "      3  999999 Nowhere, XX"])
    _lines(os.path.join(src, "cnv", "NACION3D.CNV"),
           ["     10  Brasileiro                                         010",
            "     24  Arquipelago midway                                 286"])
    convert_fixed_width(spark, os.path.join(src, "cnv", "br_uf.cnv"), STATE_LAYOUT,
                        os.path.join(raw, RAW_FOLDERS["ibge_uf"]), glob=None)
    convert_fixed_width(spark, os.path.join(src, "cnv", "br_municip.cnv"), MUNICIPALITY_LAYOUT,
                        os.path.join(raw, RAW_FOLDERS["ibge_municipios"]), glob=None)
    convert_fixed_width(spark, os.path.join(src, "cnv", "NACION3D.CNV"), NATIONALITY_LAYOUT,
                        os.path.join(raw, RAW_FOLDERS["nacional"]), glob=None)
    os.makedirs(os.path.join(src, "dbf"))
    with open(os.path.join(src, "dbf", "TB_SIGTAP.DBF"), "wb") as fh:
        fh.write(encode_dbf([("0301010072", "Consulta"), ("0303140151", "Tratamento")],
                            dbf_fields([("ip_cod", "C", 10, 0), ("ip_name", "C", 30, 0)])))
    with open(os.path.join(src, "dbf", "CID10.DBF"), "wb") as fh:
        fh.write(encode_dbf([("A01", "Febre tifoide"), ("J18", "Pneumonia")],
                            dbf_fields([("cid10", "C", 4, 0), ("descr", "C", 30, 0)])))
    convert_dbf(spark, os.path.join(src, "dbf", "TB_SIGTAP.DBF"), os.path.join(raw, RAW_FOLDERS["sigtap"]))
    convert_dbf(spark, os.path.join(src, "dbf", "CID10.DBF"), os.path.join(raw, RAW_FOLDERS["cid10"]))
    sih = os.path.join(raw, RAW_FOLDERS["sih"])
    os.makedirs(sih)
    header = ",".join(n for n, _ in FACT_COLUMNS)
    good = dict(uf_zi=110001, espec=1, sexo=3, proc_solic=301010072, proc_rea=303140151,
                diag_princ="A01", raca_cor=1, nacional=10, val_tot="12.5")
    with open(os.path.join(sih, "RDRO2301.csv"), "w") as fh:
        fh.write(header + "\n" + _fact_row(**good) + "\n" + _fact_row(**{**good, "sexo": 9}) + "\n")
    with open(os.path.join(sih, "RDSP2302.csv"), "w") as fh:
        fh.write(header + "\n" + _fact_row(**{**good, "diag_princ": "Z99", "val_tot": "abc"}) + "\n")
    return raw


def test_load_lake_end_to_end(spark, tmp):
    raw = build_raw_zone(spark, tmp)
    out = os.path.join(tmp, "lake")
    target_for = lambda name: Target.path(os.path.join(out, name))
    rep = load_lake(spark, raw, target_for)
    dims = {r.table_name: r for r in rep["dimensions"].collect()}
    assert len(dims) == 17
    assert all(r.action == "written" for r in dims.values())
    assert dims["dim_ibge_municipios"].ok and dims["dim_sigtap"].ok

    mun = {r.id: r.uf for r in spark.read.parquet(os.path.join(out, "dim_ibge_municipios")).collect()}
    assert mun == {1: "Rondônia", 2: "São Paulo", 3: None}
    nac = {r.id: r.cod for r in spark.read.parquet(os.path.join(out, "dim_nacional")).collect()}
    assert nac == {10: 10, 24: 286}

    fk = {(r.fk_column, r.dim_table): r for r in rep["foreign_keys"].collect()}
    assert len(fk) == len(FACT_FOREIGN_KEYS) == 19
    assert fk[("sexo", "dim_sexo")].orphan_rows == 1
    assert fk[("diag_princ", "dim_cid10")].orphan_rows == 1
    assert fk[("proc_rea", "dim_sigtap")].ok and fk[("espec", "dim_espec")].ok
    # uf_zi is a municipality code, checked against cod_ibge (not the key)
    assert fk[("uf_zi", "dim_ibge_municipios")].ok
    assert fk[("nacional", "dim_nacional")].target_unique is True

    fat = spark.read.parquet(os.path.join(out, "fat_sih"))
    st = spark.read.parquet(os.path.join(out, "st_sih"))
    assert fat.count() == st.count() == 3
    assert len(fat.columns) == 114
    assert sorted(r.arquivo_origem for r in fat.collect()) == ["RDRO2301.csv", "RDRO2301.csv", "RDSP2302.csv"]
    assert sorted((r.val_tot is None) for r in fat.collect()) == [False, False, True]

    again = {r.table_name: r.action for r in load_lake(spark, raw, target_for)["dimensions"].collect()}
    assert set(again.values()) == {"exists"}


def test_load_lake_gate_and_missing(spark, tmp):
    raw = os.path.join(tmp, "empty-raw")
    os.makedirs(raw)
    grid = period_state_grid(spark, 2023, 1, 2023, 1, "SP")
    none = spark.createDataFrame([], "file_name string")
    status = coverage_status(grid, none, none, none)
    rep = load_lake(spark, raw, lambda n: Target.path(os.path.join(tmp, "lake", n)), status=status)
    acts = {r.table_name: r.action for r in rep["dimensions"].collect()}
    assert acts["dim_ibge_uf"] == "missing" and acts["dim_ibge_municipios"] == "missing"
    assert acts["dim_espec"] == "written"
    assert rep["foreign_keys"].count() == 0
