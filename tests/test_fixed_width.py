"""Fixed-width scans (A4, A5, B7, B8) against a brute-force reading of the
same bytes."""

import os

from lakeloom.sources.fixed_width import (MUNICIPALITY_LAYOUT, NATIONALITY_LAYOUT, STATE_LAYOUT,
                                          FixedField, fixed_width_rejects, nationality_layout,
                                          read_fixed_width)

PY_WS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"


def brute_force(lines, layout, keep_blank=False):
    """Plain-Python statement of the rules: slice, right-strip whitespace,
    commas to spaces; int fields blank -> None, else an integer or the line
    is rejected; all-blank lines dropped."""
    out = []
    for line in lines:
        row, ok = [], True
        for f in layout:
            raw = line[f.start:f.start + f.size].rstrip(PY_WS).replace(",", " ")
            if f.type == "int":
                if not raw.strip(PY_WS):
                    row.append(None)
                else:
                    t = raw.strip(PY_WS)
                    body = t[1:] if t[:1] in "+-" else t
                    if body.isdigit() and body.isascii():
                        row.append(int(t))
                    else:
                        ok = False
            else:
                row.append(raw)
        blank = all((v is None or v == "") for v in row)
        if ok and (keep_blank or not blank):
            out.append(tuple(row))
    return sorted(out, key=repr)


LINES = [
    "      1  110001 Alta Floresta D'Oeste",              # ordinary
    "      2  110002 Ariquemes, RO                       \t",  # comma in text, trailing tab
    "   0003  000017   São Paulo",                        # leading zeros, leading spaces kept
    "      4  12,345 Bad code",                           # comma in int -> rejected
    "     xx  110005 Bad id",                             # letters in int -> rejected
    "      6         Blank code",                         # blank int -> NULL
    "      7",                                            # short line
    "",                                                   # blank line -> dropped
    "      8  +00042 Signed",                             # sign accepted
    "      9  1_0    Underscore",                         # underscore rejected
    "     10  110010 Ending comma,   ",                   # trailing comma survives as space
]


def write_latin1(path, lines, newline="\n"):
    with open(path, "wb") as fh:
        fh.write(newline.join(lines).encode("latin-1") + newline.encode())


def test_municipality_layout_matches_brute_force(spark, tmp):
    p = os.path.join(tmp, "br_municip.cnv")
    write_latin1(p, LINES)
    got = read_fixed_width(spark, p, MUNICIPALITY_LAYOUT, encoding="ISO-8859-1")
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    assert rows == brute_force(LINES, MUNICIPALITY_LAYOUT)
    by_id = {r[0]: r for r in rows}
    assert by_id[3] == (3, 17, "  São Paulo")
    assert by_id[2][2] == "Ariquemes  RO"
    assert by_id[6][1] is None
    assert by_id[10][2] == "Ending comma "
    assert 4 not in by_id and 9 not in by_id


def test_crlf_and_keep_blank(spark, tmp):
    p = os.path.join(tmp, "crlf.cnv")
    write_latin1(p, LINES, newline="\r\n")
    got = read_fixed_width(spark, p, MUNICIPALITY_LAYOUT, encoding="ISO-8859-1", keep_blank_rows=True)
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    assert rows == brute_force(LINES, MUNICIPALITY_LAYOUT, keep_blank=True)
    assert (None, None, "") in rows


def test_rejects_are_reported(spark, tmp):
    p = os.path.join(tmp, "r.cnv")
    write_latin1(p, LINES)
    rej = fixed_width_rejects(spark, p, MUNICIPALITY_LAYOUT, encoding="ISO-8859-1").collect()
    assert sorted(r.line[:7].strip() for r in rej) == ["4", "9", "xx"]
    assert {r.file_name for r in rej} == {"r.cnv"}


def test_state_layout_code_is_text(spark, tmp):
    lines = ["     11  RO Rondônia", "     35  SP São Paulo"]
    p = os.path.join(tmp, "br_uf.cnv")
    write_latin1(p, lines)
    rows = sorted(tuple(r) for r in read_fixed_width(spark, p, STATE_LAYOUT, "ISO-8859-1").collect())
    assert rows == brute_force(lines, STATE_LAYOUT)
    assert rows == [(11, "RO", "Rondônia"), (35, "SP", "São Paulo")]


def test_nationality_sample_line(spark, tmp):
    line = "     24  Arquipelago midway                                 286"
    p = os.path.join(tmp, "NACION3D.CNV")
    write_latin1(p, [line])
    row = read_fixed_width(spark, p, NATIONALITY_LAYOUT, "ISO-8859-1").collect()[0]
    assert (row.id, row.cod) == (24, 286)
    assert row.descricao == "  Arquipelago midway"      # leading spaces kept
    legacy = read_fixed_width(spark, p, nationality_layout(61), "ISO-8859-1").collect()[0]
    assert legacy.cod == 86                              # the 61 start cuts the code


def test_folder_scan_mixed_case_and_file_name(spark, tmp):
    d = os.path.join(tmp, "cnv")
    os.makedirs(d)
    write_latin1(os.path.join(d, "a.cnv"), LINES[:3])
    write_latin1(os.path.join(d, "B.CNV"), LINES[8:9])
    write_latin1(os.path.join(d, "skip.txt"), LINES[:3])
    df = read_fixed_width(spark, d, MUNICIPALITY_LAYOUT, "ISO-8859-1", glob="*.{cnv,CNV}",
                          with_file_name=True)
    assert sorted(r.file_name for r in df.collect()) == ["B.CNV", "a.cnv", "a.cnv", "a.cnv"]


def test_custom_layout_short_fields(spark, tmp):
    layout = (FixedField(0, 2, "a", "int"), FixedField(2, 3, "b", "string"))
    p = os.path.join(tmp, "x.cnv")
    write_latin1(p, ["1 abc", "-1xy", "  "])
    rows = sorted((tuple(r) for r in read_fixed_width(spark, p, layout).collect()), key=repr)
    assert rows == brute_force(["1 abc", "-1xy", "  "], layout)


def test_file_report(spark, tmp):
    from lakeloom.sources.fixed_width import fixed_width_file_report
    d = os.path.join(tmp, "rep")
    os.makedirs(d)
    write_latin1(os.path.join(d, "a.cnv"), LINES)
    write_latin1(os.path.join(d, "b.cnv"), LINES[:2])
    rep = {r.file_name: (r.lines, r.kept, r.rejected, r.blank)
           for r in fixed_width_file_report(spark, d, MUNICIPALITY_LAYOUT, "ISO-8859-1").collect()}
    kept = len(brute_force(LINES, MUNICIPALITY_LAYOUT))
    assert rep["a.cnv"] == (len(LINES), kept, 3, 1)
    assert rep["b.cnv"] == (2, 2, 0, 0)
