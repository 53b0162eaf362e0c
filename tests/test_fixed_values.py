"""The fixed values agree with each other (no Spark needed)."""

from sensorweave import schemas as S
from sensorweave.functions import fixed
from sensorweave.plans import graph_build as GB
from sensorweave.operators.rdf import number  # noqa: F401 - module imports cleanly


def _num(text):
    return float(text.replace("−", "-"))


def test_default_limits_follow_the_ontology_with_symmetric_force_and_torque():
    stated = {p: (_num(lo), _num(hi)) for _, p, lo, hi in fixed.KB_RESTRICTIONS}
    assert set(stated) == set(fixed.DEFAULT_LIMITS)
    for p, (lo, hi) in stated.items():
        want = (-hi, hi) if p in ("hasForce", "hasTorque") else (lo, hi)
        assert fixed.DEFAULT_LIMITS[p] == want


def test_governed_columns_exist_in_the_staging_schema():
    cols = set(S.STAGING_COLUMNS)
    assert set(fixed.PROPERTY_COLUMNS) == set(fixed.DEFAULT_LIMITS)
    for props in fixed.PROPERTY_COLUMNS.values():
        assert set(props) <= cols


def test_seed_edges_connect_seeded_nodes():
    for full in (False, True):
        nodes, edges = GB.seed_rows(full)
        names = {(lbl, name) for lbl, name, _ in nodes}
        for _t, sl, sn, dl, dn in edges:
            assert (sl, sn) in names and (dl, dn) in names


def test_log_messages_cover_every_log_type():
    assert set(fixed.LOG_MESSAGES) == {"warn", "info", "error"}
