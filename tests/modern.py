"""The six-vertex graph: two labels, two edge types, pipe-separated files."""

from __future__ import annotations

from pathlib import Path

from weftgraph import GraphSchema, ImportSpec, Triplet

KNOWS = Triplet("person", "knows", "person")
CREATED = Triplet("person", "created", "software")

FILES = {
    "person.csv": "id|name|age\n1|marko|29\n2|vadas|27\n4|josh|32\n6|peter|35",
    "software.csv": "id|name|lang\n3|lop|java\n5|ripple|java",
    "knows.csv": "person.id|person2.id|weight\n1|2|0.5\n1|4|1.0",
    "created.csv": "person.id|software.id|weight|year\n1|3|0.4|2004\n4|3|0.4|2008\n6|3|0.2|2010\n2|5|1.0|2022",
}

SCHEMA_YAML = """
name: modern_graph
store_type: mutable_csr
schema:
  vertex_types:
    - type_name: person
      properties:
        - {property_name: id, property_type: {primitive_type: DT_SIGNED_INT64}}
        - {property_name: name, property_type: {primitive_type: DT_STRING}}
        - {property_name: age, property_type: {primitive_type: DT_SIGNED_INT32}}
      primary_keys: [id]
    - type_name: software
      properties:
        - {property_name: id, property_type: {primitive_type: DT_SIGNED_INT64}}
        - {property_name: name, property_type: {primitive_type: DT_STRING}}
        - {property_name: lang, property_type: {primitive_type: DT_STRING}}
      primary_keys: [id]
  edge_types:
    - type_name: knows
      vertex_type_pair_relations:
        - {source_vertex: person, destination_vertex: person, relation: MANY_TO_MANY}
      properties:
        - {property_name: weight, property_type: {primitive_type: DT_DOUBLE}}
    - type_name: created
      vertex_type_pair_relations:
        - {source_vertex: person, destination_vertex: software, relation: MANY_TO_MANY}
      properties:
        - {property_name: weight, property_type: {primitive_type: DT_DOUBLE}}
"""

IMPORT_YAML = """
graph: modern_graph
loading_config:
  data_source: {scheme: file, location: LOCATION}
  import_option: init
  format:
    type: csv
    metadata: {delimiter: "|", header_row: true, quoting: false, quote_char: '"', double_quote: true}
vertex_mappings:
  - type_name: person
    inputs: [person.csv]
    column_mappings:
      - {column: {index: 0, name: id}, property: id}
      - {column: {index: 1, name: name}, property: name}
      - {column: {index: 2, name: age}, property: age}
  - type_name: software
    inputs: [software.csv]
    column_mappings:
      - {column: {index: 0, name: id}, property: id}
      - {column: {index: 1, name: name}, property: name}
      - {column: {index: 2, name: lang}, property: lang}
edge_mappings:
  - type_triplet: {edge: knows, source_vertex: person, destination_vertex: person}
    inputs: [knows.csv]
    source_vertex_mappings: [{column: {index: 0, name: person.id}}]
    destination_vertex_mappings: [{column: {index: 1, name: person.id2}}]
    column_mappings: [{column: {index: 2, name: weight}, property: weight}]
  - type_triplet: {edge: created, source_vertex: person, destination_vertex: software}
    inputs: [created.csv]
    source_vertex_mappings: [{column: {index: 0, name: person.id}}]
    destination_vertex_mappings: [{column: {index: 1, name: software.id}}]
    column_mappings: [{column: {index: 2, name: weight}, property: weight}]
"""


def write_files(folder: Path) -> Path:
    for name, text in FILES.items():
        (folder / name).write_text(text)
    return folder


def schema() -> GraphSchema:
    return GraphSchema.from_yaml(SCHEMA_YAML)


def spec(folder: Path, edit=lambda text: text) -> ImportSpec:
    return ImportSpec.from_yaml(edit(IMPORT_YAML.replace("LOCATION", str(folder))))
