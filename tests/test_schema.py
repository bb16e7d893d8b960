import pytest
from support import rows

from changevault.functions.records import extract_fields
from changevault.model import COMPOUND_TYPES, SOURCE_TYPES, ChangeVaultError, DriftHalted, check_case_collisions
from changevault.operators.schema import (
    apply_removed_policy, columns_from_catalog, detect_drift, dry_run, evolve, removed_policy,
    type_changes, without_intentional,
)

COLUMNS = "object string, name string, type string, required boolean"
CATALOG = "object string, name string, type string, length int, precision int, scale int, nillable boolean"


def columns(spark, *cols, object_name="Lead"):
    return spark.createDataFrame([(object_name, n, t, False) for n, t in cols], COLUMNS)


def catalog(spark, *fields, object_name="Lead"):
    return spark.createDataFrame([(object_name, n, t, 0, 0, 0, nil) for n, t, nil in fields], CATALOG)


def policies(spark, policy, overflow=False, object_name="Lead"):
    return spark.createDataFrame(
        [(object_name, overflow, policy)], "object string, overflow boolean, removed_field_policy string"
    )


def test_every_source_type(spark):
    fields = [(f"f_{t}", t, True) for t in [*SOURCE_TYPES, *COMPOUND_TYPES, "somethingnew"]]
    got = columns_from_catalog(catalog(spark, *fields))
    want = {f"f_{t}": c for t, c in SOURCE_TYPES.items()} | {"f_somethingnew": "string"}
    assert {r.name: r.type for r in got.collect()} == want


def test_excludes_and_required(spark):
    fields = catalog(spark, ("Id", "id", False), ("PhotoUrl", "url", True), ("Name", "string", True), ("X", None, True))
    excludes = spark.createDataFrame([("Lead", "PhotoUrl"), ("Other", "Name")], "object string, name string")
    assert rows(columns_from_catalog(fields, excludes)) == [
        ("Lead", "Id", "string", True), ("Lead", "Name", "string", False), ("Lead", "X", "string", False),
    ]


@pytest.mark.parametrize("current, desired, expected", [
    ([("Id", "string"), ("Amount", "double")], [("Id", "string"), ("Amount", "double")], []),
    ([("Id", "string")], [("Id", "string"), ("CreatedDate", "timestamp")],
     [("Lead", "new", "CreatedDate", None, "timestamp")]),
    ([("Id", "string"), ("OldField", "string")], [("Id", "string")], [("Lead", "removed", "OldField", "string", None)]),
    ([("Score", "int")], [("Score", "long")], [("Lead", "type_change", "Score", "int", "long")]),
    ([("Name", "string")], [("name", "string")],
     [("Lead", "new", "name", None, "string"), ("Lead", "removed", "Name", "string", None)]),
    ([("Id", "string"), ("_overflow", "string")], [("Id", "string")], []),
])
def test_detect_drift(spark, current, desired, expected):
    assert rows(detect_drift(columns(spark, *current), columns(spark, *desired))) == expected


def test_drift_keeps_objects_apart(spark):
    current = columns(spark, ("Id", "string")).union(columns(spark, ("Id", "string"), object_name="Task"))
    desired = columns(spark, ("Id", "long")).union(columns(spark, ("Id", "string"), object_name="Task"))
    drift = detect_drift(current, desired)
    assert rows(type_changes(drift)) == [("Lead", "Id", "string", "long")]


def test_intentional_drop_is_no_removal(spark):
    current = columns(spark, ("Id", "string"), ("PhotoUrl", "string"), ("Gone", "string"))
    fields = catalog(spark, ("Id", "id", False), ("PhotoUrl", "url", True))
    drift = without_intentional(detect_drift(current, columns(spark, ("Id", "string"))), fields)
    assert rows(drift.select("change", "name")) == [("removed", "Gone")]


def test_policies(spark):
    drift = detect_drift(columns(spark, ("Id", "string"), ("ExtraCol", "string")), columns(spark, ("Id", "string")))
    with pytest.raises(DriftHalted, match="Lead.*ExtraCol"):
        apply_removed_policy(drift, policies(spark, "halt"))
    for policy in ("tombstone", "anything", None):
        assert rows(apply_removed_policy(drift, policies(spark, policy))) == [("Lead", "ExtraCol", "tombstone")]
    other = policies(spark, "halt", object_name="Task")
    assert rows(removed_policy(drift, other)) == [("Lead", "ExtraCol", "tombstone")]


def test_evolve(spark):
    current = columns(spark, ("Id", "string"), ("Old", "string"))
    drift = detect_drift(current, columns(spark, ("Id", "string"), ("NewField", "string")))
    names = lambda df: sorted(r.name for r in df.collect())
    assert names(evolve(current, drift)) == ["Id", "NewField", "Old"]
    assert names(evolve(current, drift, policies(spark, "tombstone", overflow=True))) == ["Id", "Old"]
    assert not evolve(current, drift).where("name = 'NewField'").first().required


def test_dry_run(spark):
    current = columns(spark, ("Id", "string"), ("Gone", "string"), ("N", "int"))
    current = current.union(columns(spark, ("Id", "string"), object_name="Same"))
    current = current.union(columns(spark, ("Id", "string"), object_name="Missing"))
    desired = columns(spark, ("Id", "string"), ("Fresh", "string"), ("N", "long"))
    desired = desired.union(columns(spark, ("Id", "string"), object_name="Same"))
    desired = desired.union(columns(spark, ("Id", "string"), object_name="Create"))
    assert rows(dry_run(current, desired)) == [
        ("Create", 0, 1, 1, 0, 0, ["Id"], [], [], False, "create"),
        ("Lead", 3, 3, 1, 1, 1, ["Fresh"], ["Gone"], ["N"], True, "drift"),
        ("Missing", 1, 0, 0, 1, 0, [], ["Id"], [], False, "missing"),
        ("Same", 1, 1, 0, 0, 0, [], [], [], False, "same"),
    ]


@pytest.mark.parametrize("names, stamp, expected", [
    (["Id", "LastModifiedDate", "Amount"], "LastModifiedDate", ["Id", "LastModifiedDate", "Amount", "IsDeleted"]),
    (["Id", "Name"], "SystemModstamp", ["Id", "Name", "SystemModstamp", "IsDeleted"]),
    (["Id"], "", ["Id", "IsDeleted"]),
    (["Id", "IsDeleted"], "SystemModstamp", ["Id", "IsDeleted", "SystemModstamp"]),
    (["Id", "_overflow"], "", ["Id", "IsDeleted"]),
])
def test_extract_fields(names, stamp, expected):
    assert extract_fields(names, stamp) == expected


def test_case_collision():
    check_case_collisions(["Id", "Name"])
    with pytest.raises(ChangeVaultError, match="only in case"):
        check_case_collisions(["Id", "ID"])
