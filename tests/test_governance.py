import copy

import pytest

from strataflow.operators.governance import (
    filter_rows,
    governed,
    governed_temp_view,
    governed_view,
    mask,
    member_of,
    member_sql,
    membership_table,
    nested_membership,
    policy_functions,
)

POLICY = {
    "table_name": "vans",
    "comment": "not read",
    "masking_functions": [
        {"target_col": "plate", "type": "mask_email_dynamic", "params": {"allowed_group": "dispatch"}}
    ],
    "row_filters": [
        {
            "type": "filter_dept_dynamic",
            "params": {
                "col_dept": "zone",
                "allowed_group": "dispatch",
                "restrict_to_dept": "south",
            },
        }
    ],
}
MEMBER = [("1", "KX 41", "south"), ("2", None, "north"), ("3", "QT 77", None)]
OTHER = [("1", "***@****", "south")]


@pytest.fixture(scope="module")
def vans(spark):
    return spark.createDataFrame(MEMBER, "id string, plate string, zone string")


@pytest.fixture(scope="module")
def people(spark):
    rows = [("ann", "dispatch"), ("bob", "readers")]
    frame = spark.createDataFrame(rows, "principal string, `group` string")
    frame.createOrReplaceTempView("people_groups")
    return frame


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_mask_hides_null_too(vans):
    hidden = mask(vans, "plate", member_of([])("dispatch"))
    assert {r.plate for r in hidden.collect()} == {"***@****"}
    shown = mask(vans, "plate", member_of(["dispatch"])("dispatch"))
    assert sorted(map(repr, rows_of(shown))) == sorted(map(repr, MEMBER))


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]


def test_row_filter_hides_null(vans):
    member = member_of([])("dispatch")
    assert [r.id for r in filter_rows(vans, "zone", "south", member).collect()] == ["1"]


def test_governed(vans):
    assert rows(governed(vans, [POLICY], member_of([]))) == OTHER
    assert governed(vans, [POLICY], member_of(["dispatch"])).count() == 3


def test_filter_sees_unmasked_values(vans):
    policy = copy.deepcopy(POLICY)
    policy["masking_functions"][0]["target_col"] = "zone"
    assert rows(governed(vans, [policy], member_of([]))) == [("1", "KX 41", "***@****")]


def test_several_policies_and_repeated_use(vans):
    second = copy.deepcopy(POLICY)
    second["row_filters"][0]["params"]["restrict_to_dept"] = "north"
    policies = [POLICY, second]
    before = copy.deepcopy(policies)
    assert governed(vans, policies, member_of([])).count() == 0
    assert governed(vans, policies, member_of([])).count() == 0
    assert policies == before


def test_membership_table(vans, people):
    assert governed(vans, [POLICY], membership_table(people, "ann")).count() == 3
    assert rows(governed(vans, [POLICY], membership_table(people, "bob"))) == OTHER
    assert rows(governed(vans, [POLICY], membership_table(people))) == OTHER


def test_temp_view_with_functions(spark, vans, people):
    view = governed_temp_view(vans, "vans_v", [POLICY], member_sql("people_groups", "bob"))
    assert rows(view) == OTHER and rows(spark.sql("SELECT * FROM vans_v")) == OTHER
    governed_temp_view(vans, "vans_v", [POLICY], member_sql("people_groups", "ann"))
    assert spark.table("vans_v").count() == 3


def test_stored_view(spark, vans, folder):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS gov LOCATION '{folder}/gov'")
    vans.write.saveAsTable("gov.vans")
    spark.createDataFrame([("bob", "readers")], "principal string, `group` string").write.saveAsTable(
        "gov.members"
    )
    try:
        view = governed_view(
            spark, "gov.vans", "gov.vans_v", [POLICY], member_sql("gov.members", "bob"), "gov"
        )
        assert rows(view) == OTHER
    finally:
        spark.sql("DROP DATABASE gov CASCADE")


def test_function_names_and_quoting():
    policy = copy.deepcopy(POLICY)
    policy["row_filters"][0]["params"]["restrict_to_dept"] = "O'Hara"
    statements, filters, masks = policy_functions([policy, POLICY], lambda g: "false")
    assert [n for n, _ in filters] == [
        "sec_vans_filter_dept_dynamic",
        "sec_vans_filter_dept_dynamic_1",
    ]
    assert [n for n, _ in masks] == ["sec_vans_mask_email_dynamic", "sec_vans_mask_email_dynamic_1"]
    assert "O\\'Hara" in statements[0]


@pytest.mark.parametrize("section", ["masking_functions", "row_filters"])
def test_unknown_policy(vans, section):
    policy = copy.deepcopy(POLICY)
    policy[section][0]["type"] = "invented"
    with pytest.raises(ValueError, match="unknown policy 'invented'"):
        governed(vans, [policy], member_of([]))


def test_only_strings_can_be_masked(spark):
    with pytest.raises(ValueError, match="string column"):
        mask(spark.range(1), "id", member_of([])("g"))


def test_known_membership_folds_away(vans):
    frame = filter_rows(vans, "zone", "south", member_of(["dispatch"])("dispatch"))
    assert "Filter" not in frame._jdf.queryExecution().optimizedPlan().toString()


def test_nested_groups(spark):
    """Groups in groups over three levels, two ways to one group, and circles."""
    direct = [("ann", "dev"), ("ann", "dev"), ("dev", "tech"), ("ops", "tech"), ("ann", "ops"), ("tech", "staff"), ("staff", "dev"), ("bob", "bob"), ("eve", None)]
    frame = spark.createDataFrame(direct, "principal STRING, group STRING")
    found = {(r.principal, r.group) for r in nested_membership(frame).collect()}
    assert {g for p, g in found if p == "ann"} == {"dev", "ops", "tech", "staff"}
    assert {g for p, g in found if p == "tech"} == {"staff", "dev", "tech"}
    assert ("bob", "bob") in found and len(found) == nested_membership(frame).count()
    rows = spark.createDataFrame([("x",), ("y",)], "dept STRING")
    for who, seen in (("ann", 2), ("bob", 1)):
        member = membership_table(nested_membership(frame), who)("staff")
        assert filter_rows(rows, "dept", "x", member).count() == seen


def test_nested_groups_by_many_ways(spark):
    """Two million ways between the ends of 22 levels, and 150 groups one in another."""
    steps = [(f"{level}_{a}", f"{level + 1}_{b}") for level in range(21) for a in "xy" for b in "xy"]
    chain = [(f"c{k}", f"c{k + 1}") for k in range(150)]
    direct = spark.createDataFrame([("ann", "0_x"), ("bob", "c0"), *steps, *chain], "principal STRING, group STRING")
    found = nested_membership(direct).groupBy("principal").count()
    counts = {r["principal"]: r["count"] for r in found.collect()}
    assert counts["ann"] == 1 + 21 * 2 and counts["bob"] == 151 and counts["0_x"] == 21 * 2 and counts["c149"] == 1


def test_row_filter_by_many_ways(spark):
    steps = [(f"{level}_{a}", f"{level + 1}_{b}") for level in range(21) for a in "xy" for b in "xy"]
    direct = spark.createDataFrame([("ann", "0_x"), ("eve", "21_y"), *steps], "principal STRING, group STRING")
    rows = spark.createDataFrame([("x",), ("y",), (None,)], "dept STRING")
    for who, seen in (("ann", 3), ("eve", 1)):
        member = membership_table(nested_membership(direct), who)("21_x")
        assert filter_rows(rows, "dept", "x", member).count() == seen
