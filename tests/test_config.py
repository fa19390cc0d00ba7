import copy
import json

import pytest

from strataflow.plans.config import DocumentError, load_document, parse_document
from strataflow.plans.pipeline import Pipeline

GOOD = {
    "dataflows": [
        {
            "name": "f",
            "sources": [{"name": "in", "path": "/x"}],
            "transformations_silver": [
                {
                    "target_silver_table": "s",
                    "source_bronze": "in",
                    "scd_config": {"keys": ["id"], "sequence_by": "ts", "stored_as_scd_type": "2"},
                }
            ],
            "transformations_gold": [{"target_gold_table": "g", "source_silver": "s"}],
        }
    ]
}


def test_defaults():
    document = parse_document(GOOD)
    source = document.sources[0]
    assert (source.format, source.paths, source.multi_line) == ("JSON", ("/x",), True)
    assert document.silvers[0].scd_type == 2 and document.golds[0].history == "all"


def test_sections_are_optional():
    assert parse_document({"dataflows": [{"sources": [{"name": "a", "paths": ["/x", "/y"]}]}]})


@pytest.mark.parametrize("bad", [{}, {"dataflows": []}, {"dataflows": {}}, {"dataflows": [{}]}])
def test_rejected_documents(bad):
    with pytest.raises(DocumentError):
        parse_document(bad)


@pytest.mark.parametrize(
    "section, key",
    [
        ("transformations_silver", "target_silver_table"),
        ("transformations_silver", "source_bronze"),
        ("transformations_silver", "scd_config"),
        ("transformations_gold", "target_gold_table"),
        ("transformations_gold", "source_silver"),
        ("sources", "name"),
        ("sources", "path"),
    ],
)
def test_missing_keys(section, key):
    bad = copy.deepcopy(GOOD)
    del bad["dataflows"][0][section][0][key]
    with pytest.raises(DocumentError, match=key):
        parse_document(bad)


def test_keys_must_be_a_list_and_type_known():
    for change in ({"keys": "id"}, {"keys": []}, {"stored_as_scd_type": 3}):
        bad = copy.deepcopy(GOOD)
        bad["dataflows"][0]["transformations_silver"][0]["scd_config"].update(change)
        with pytest.raises(DocumentError):
            parse_document(bad)


def test_same_table_twice():
    bad = copy.deepcopy(GOOD)
    bad["dataflows"].append(copy.deepcopy(GOOD["dataflows"][0]))
    with pytest.raises(DocumentError, match="declared twice"):
        parse_document(bad)


def test_sources_of_one_table_may_be_in_two_flows():
    two = copy.deepcopy(GOOD)
    two["dataflows"].append({"sources": [{"name": "in", "path": "/y"}]})
    assert len(parse_document(two).bronze_tables["in"]) == 2


def test_load_from_file(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps(GOOD, indent=2))
    assert load_document(spark, f"file://{tmp_path}/d.json") == parse_document(GOOD)


def test_names_resolve_in_any_order_and_cycles_fail(spark):
    pair = copy.deepcopy(GOOD)
    pair["dataflows"][0]["transformations_gold"] = [
        {"target_gold_table": "g1", "source_silver": "g2"},
        {"target_gold_table": "g2", "source_silver": "s_quarantine"},
    ]
    order = Pipeline(spark, pair).order
    assert order.index("s_quarantine") < order.index("g2") < order.index("g1")
    pair["dataflows"][0]["transformations_gold"][1]["source_silver"] = "g1"
    with pytest.raises(ValueError, match="cycle"):
        Pipeline(spark, pair)
    pair["dataflows"][0]["transformations_gold"][1]["source_silver"] = "nowhere"
    with pytest.raises(ValueError, match="unknown tables"):
        Pipeline(spark, pair)
