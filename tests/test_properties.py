"""Property tests: random inputs against plain-Python statements of the rules.
Each example is a whole batch of rows, so one Spark job checks many cases."""

import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeloom.operators.manifest import period_state_grid
from lakeloom.sources.fixed_width import FixedField, read_fixed_width

from .test_fixed_width import brute_force, write_latin1

LAYOUT = (FixedField(0, 4, "a", "int"), FixedField(4, 6, "b", "string"),
          FixedField(10, 3, "c", "int"))

# characters that exercise the rules: digits, signs, commas, spaces, tabs,
# letters, Latin-1 accents and no-break space
ALPHABET = st.sampled_from(list("0123456789+-, \tabxyzé\xa0_."))
LINE = st.text(alphabet=ALPHABET, min_size=0, max_size=16)

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(lines=st.lists(LINE, min_size=1, max_size=60))
def test_fixed_width_matches_python_rules(spark, tmp_path_factory, lines):
    d = str(tmp_path_factory.mktemp("fw"))
    p = os.path.join(d, "x.cnv")
    # line breaks inside generated text would split lines; none are generated
    write_latin1(p, lines)
    got = sorted((tuple(r) for r in read_fixed_width(spark, p, LAYOUT, "ISO-8859-1").collect()),
                 key=repr)
    assert got == brute_force(lines, LAYOUT)


def python_grid(sy, sm, ey, em, states):
    out, y, m = [], sy, sm
    while (y, m) <= (ey, em):
        for s in states:
            out.append(f"RD{s}{y % 100:02d}{m:02d}.dbc")
        m += 1
        if m > 12:
            y, m = y + 1, 1
    return out


@SETTINGS
@given(sy=st.integers(1995, 2030), sm=st.integers(1, 12), span=st.integers(-3, 40),
       states=st.lists(st.sampled_from(["SP", "RJ", "AC", "MG"]), min_size=1, max_size=3, unique=True))
def test_grid_matches_month_loop(spark, sy, sm, span, states):
    end = sy * 12 + (sm - 1) + span
    ey, em = divmod(end, 12)
    em += 1
    g = period_state_grid(spark, sy, sm, ey, em, ",".join(states))
    assert [r.file_name for r in g.orderBy("seq").collect()] == python_grid(sy, sm, ey, em, states)
