"""Property test: json_value on random documents equals a plain-Python model
(scalar -> its text; object, array, JSON null or missing path -> NULL)."""

import json
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pluvio.functions import json_value

KEYS = st.sampled_from(["a", "b", "C", "d_1"])
SCALARS = st.one_of(
    st.none(),
    st.booleans(),
    st.integers(-10**6, 10**6),
    st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False),
    st.text(alphabet="xyz{[ 1.", max_size=6),
)
DOCS = st.recursive(
    SCALARS,
    lambda inner: st.one_of(st.lists(inner, max_size=3), st.dictionaries(KEYS, inner, max_size=3)),
    max_leaves=8,
)
PATHS = st.lists(st.one_of(KEYS, st.integers(0, 2)), min_size=1, max_size=3)


def _path_text(path):
    out = "$"
    for p in path:
        out += f"[{p}]" if isinstance(p, int) else f".{p}"
    return out


def _model(doc, path):
    cur = doc
    for p in path:
        if isinstance(p, int):
            if not isinstance(cur, list) or p >= len(cur):
                return None
        elif not isinstance(cur, dict) or p not in cur:
            return None
        cur = cur[p]
    if cur is None or isinstance(cur, (dict, list)):
        return None
    return cur


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(doc=st.dictionaries(KEYS, DOCS, min_size=1, max_size=4), paths=st.lists(PATHS, min_size=1, max_size=6))
def test_json_value_matches_model(spark, doc, paths):
    text = json.dumps(doc)
    df = spark.createDataFrame([(text,)], "j string").select(F.parse_json("j").alias("d"))
    got = df.select(*[json_value("d", _path_text(p)).alias(f"c{i}") for i, p in enumerate(paths)]).first()
    for i, p in enumerate(paths):
        want, have = _model(doc, p), got[f"c{i}"]
        if want is None:
            assert have is None, (p, doc)
        elif isinstance(want, bool):
            assert have == ("true" if want else "false")
        elif isinstance(want, (int, float)):
            assert math.isclose(float(have), float(want), rel_tol=1e-12, abs_tol=1e-12)
        else:
            assert have == want
