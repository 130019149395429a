"""Specification errors are raised before any job; lookups and defaults."""

from __future__ import annotations

from dataclasses import replace

import pytest

import modern
from modern import CREATED, KNOWS
from weftgraph import GraphSchema, ImportSpec, SpecError, Triplet
from weftgraph.functions.types import STORED_AS, spark_type
from weftgraph.spec import (
    DataSource,
    edge_property_fields,
    endpoint_fields,
    key_column,
    validate,
    vertex_fields,
)


def edited_spec(*edits):
    text = modern.IMPORT_YAML.replace("LOCATION", "/nowhere")
    for old, new in edits:
        assert old in text
        text = text.replace(old, new)
    return ImportSpec.from_yaml(text)


def edited_schema(*edits):
    text = modern.SCHEMA_YAML
    for old, new in edits:
        assert old in text
        text = text.replace(old, new)
    return GraphSchema.from_yaml(text)


SCHEMA, SPEC = edited_schema(), edited_spec()


def test_schema_binds():
    assert SCHEMA.name == "modern_graph"
    assert [v.name for v in SCHEMA.vertex_types] == ["person", "software"]
    assert [e.name for e in SCHEMA.edge_types] == ["knows", "created"]
    assert SCHEMA.key("person").type == "DT_SIGNED_INT64"


def test_mapping_binds():
    assert SPEC.graph == "modern_graph"
    assert SPEC.source.file_format == "csv"
    assert SPEC.source.options["quoting"] == "false"
    assert SPEC.source.options["header_row"] == "true"
    assert SPEC.save_mode == "errorifexists"
    validate(SCHEMA, SPEC)


def test_yaml_from_a_path(spark, tmp_path):
    (tmp_path / "graph.yaml").write_text(modern.SCHEMA_YAML)
    (tmp_path / "import.yaml").write_text(modern.IMPORT_YAML)
    assert GraphSchema.load(spark, str(tmp_path / "graph.yaml")) == SCHEMA
    assert ImportSpec.load(spark, str(tmp_path / "import.yaml")).edges == SPEC.edges


def test_fields_follow_the_mapping():
    assert [(f.column, f.name, f.type, f.index) for f in vertex_fields(SCHEMA, SPEC, "person")] == [
        ("id", "id", "DT_SIGNED_INT64", 0),
        ("name", "name", "DT_STRING", 1),
        ("age", "age", "DT_SIGNED_INT32", 2),
    ]
    src, dst = endpoint_fields(SCHEMA, SPEC, KNOWS)
    assert (src.column, src.name, dst.column, dst.name) == ("person.id", "src", "person.id2", "dst")
    src, dst = endpoint_fields(SCHEMA, SPEC, KNOWS, "source")
    assert (src.name, dst.name) == ("person.id", "person.id2")
    assert [f.name for f in edge_property_fields(SCHEMA, SPEC, CREATED)] == ["weight"]


def test_a_vertex_mapping_may_leave_properties_out():
    spec = edited_spec(("      - {column: {index: 2, name: age}, property: age}\n", ""))
    validate(SCHEMA, spec)
    assert [f.name for f in vertex_fields(SCHEMA, spec, "person")] == ["id", "name"]


def test_without_a_mapping_all_properties_are_read_by_name():
    spec = edited_spec(("    column_mappings: [{column: {index: 2, name: weight}, property: weight}]\n", ""))
    validate(SCHEMA, spec)
    assert [(f.column, f.name) for f in edge_property_fields(SCHEMA, spec, KNOWS)] == [("weight", "weight")]
    bare = replace(SPEC, vertices=tuple(replace(v, columns=()) for v in SPEC.vertices))
    validate(SCHEMA, bare)
    assert [f.column for f in vertex_fields(SCHEMA, bare, "software")] == ["id", "name", "lang"]
    assert key_column(SCHEMA, bare, "software", "source") == "id"


def test_key_column_by_naming():
    spec = edited_spec(("{index: 0, name: id}, property: id", "{index: 0, name: uid}, property: id"))
    assert key_column(SCHEMA, spec, "person") == "id"
    assert key_column(SCHEMA, spec, "person", "source") == "uid"


@pytest.mark.parametrize(
    "edit",
    [
        ("name: person.id2", "name: person.id"),
        ("source_vertex_mappings: [{column: {index: 0, name: person.id}}]", "source_vertex_mappings: []"),
        (
            "destination_vertex_mappings: [{column: {index: 1, name: software.id}}]",
            "destination_vertex_mappings: [{column: {name: software.id}}, {column: {name: other}}]",
        ),
        ("name: software.id}", 'name: ""}'),
        ("{index: 1, name: name}, property: name", '{index: 1, name: name}, property: ""'),
        ("{index: 1, name: name}, property: name", '{index: 1, name: ""}, property: name'),
        ("property: lang", "property: language"),
        ("property: age", "property: name"),
        ("{index: 0, name: id}, property: id", "{index: 0, name: id}, property: name"),
        ("type_name: software", "type_name: hardware"),
        ("type_name: software", "type_name: person"),
        ("edge: created", "edge: made"),
        ("destination_vertex: software", "destination_vertex: person"),
        ("scheme: file", "scheme: ''"),
        ("scheme: file", "scheme: File"),
        ("scheme: file", "scheme: ftp"),
        ("type: csv", "type: arrow"),
        ("import_option: init", "import_option: append"),
        ("inputs: [person.csv]", "inputs: []"),
    ],
)
def test_wrong_mappings_are_refused(edit):
    with pytest.raises(SpecError):
        validate(SCHEMA, edited_spec(edit))


@pytest.mark.parametrize(
    "edit",
    [
        ("primary_keys: [id]", "primary_keys: [id, name]"),
        ("primary_keys: [id]", "primary_keys: []"),
        ("primary_keys: [id]", "primary_keys: [uid]"),
        ("primitive_type: DT_DOUBLE", "primitive_type: DT_FLOAT"),
        ("primitive_type: DT_DOUBLE", "primitive_type: dt_double"),
        ("property_name: weight", "property_name: heft"),
        (
            "        - {property_name: weight, property_type: {primitive_type: DT_DOUBLE}}\n",
            "        - {property_name: weight, property_type: {primitive_type: DT_DOUBLE}}\n"
            "        - {property_name: since, property_type: {primitive_type: DT_SIGNED_INT64}}\n",
        ),
    ],
)
def test_wrong_schemas_are_refused(edit):
    with pytest.raises(ValueError):
        validate(edited_schema(edit), SPEC)


def test_engine_columns_are_reserved():
    schema = edited_schema(("property_name: age", "property_name: Vid"))
    spec = edited_spec(("property: age", "property: Vid"))
    with pytest.raises(SpecError, match="vid"):
        validate(schema, spec)


def test_an_edge_type_serves_several_pairs():
    pair = "        - {source_vertex: person, destination_vertex: software, relation: MANY_TO_MANY}\n"
    schema = edited_schema((pair, pair + pair.replace("person", "software")))
    assert schema.edge(CREATED) is schema.edge(Triplet("software", "created", "software"))
    with pytest.raises(SpecError):
        schema.edge(Triplet("person", "created", "person"))


def test_schemes_are_all_lower_or_all_upper_case():
    assert DataSource("FILE").kind == "file"
    assert DataSource("table").kind == "table"
    assert DataSource("file").file_format == "csv"


def test_scheme_aliases():
    text = modern.IMPORT_YAML.replace("scheme: file", "scheme: warehouse")
    assert ImportSpec.from_yaml(text, {"warehouse": "table"}).source.kind == "table"


def test_every_declared_type():
    stored = {name: spark_type(name).simpleString() for name in STORED_AS}
    assert stored == {
        "DT_SIGNED_INT64": "bigint",
        "DT_SIGNED_INT32": "int",
        "DT_STRING": "string",
        "DT_STRINGMAP": "string",
        "DT_DOUBLE": "double",
        "DT_BOOL": "boolean",
        "DT_SIGNED_INT8": "int",
        "DT_UNSIGNED_INT8": "int",
        "DT_SIGNED_INT16": "int",
        "DT_UNSIGNED_INT16": "int",
    }
