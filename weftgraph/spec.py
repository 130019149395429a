"""What to load: the graph schema and the import mapping.

Both are small driver-side documents (YAML text or plain dicts). ``validate``
finds every specification error before a Spark job is started.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from weftgraph.functions.types import spark_type

# Columns the engine adds next to the properties; no property may use them.
RESERVED = ("src", "dst", "vid", "src_vid", "dst_vid", "vertex_chunk", "edge_chunk", "pos", "edge_row")

SCHEMES = ("file", "table")
FILE_FORMATS = ("csv", "parquet", "orc")


class SpecError(ValueError):
    """The schema and the mapping do not describe a loadable graph."""


@dataclass(frozen=True)
class Property:
    name: str
    type: str


@dataclass(frozen=True)
class VertexType:
    name: str
    properties: tuple[Property, ...]
    primary_keys: tuple[str, ...]


@dataclass(frozen=True)
class EdgePair:
    source: str
    destination: str
    relation: str = ""
    out_only: bool = False


@dataclass(frozen=True)
class EdgeType:
    name: str
    pairs: tuple[EdgePair, ...]
    properties: tuple[Property, ...] = ()


@dataclass(frozen=True, order=True)
class Triplet:
    source: str
    edge: str
    destination: str

    def __str__(self) -> str:
        return f"{self.source}-{self.edge}->{self.destination}"


@dataclass(frozen=True)
class GraphSchema:
    name: str
    vertex_types: tuple[VertexType, ...]
    edge_types: tuple[EdgeType, ...] = ()

    def vertex(self, label: str) -> VertexType:
        for candidate in self.vertex_types:
            if candidate.name == label:
                return candidate
        raise SpecError(f"vertex label {label!r} is not in the schema")

    def edge(self, triplet: Triplet) -> EdgeType:
        return self._edge_and_pair(triplet)[0]

    def pair(self, triplet: Triplet) -> EdgePair:
        return self._edge_and_pair(triplet)[1]

    def _edge_and_pair(self, triplet: Triplet) -> tuple[EdgeType, EdgePair]:
        for candidate in self.edge_types:
            if candidate.name != triplet.edge:
                continue
            for pair in candidate.pairs:
                if (pair.source, pair.destination) == (triplet.source, triplet.destination):
                    return candidate, pair
        raise SpecError(f"edge {triplet} is not in the schema")

    def key(self, label: str) -> Property:
        """The single primary-key property of a label."""
        vertex = self.vertex(label)
        if len(vertex.primary_keys) != 1:
            raise SpecError(f"label {label!r} needs exactly one primary key, has {len(vertex.primary_keys)}")
        return find_property(vertex.properties, vertex.primary_keys[0], f"label {label!r}")

    @staticmethod
    def from_dict(document: Mapping) -> GraphSchema:
        body = document.get("schema") or {}
        return GraphSchema(
            name=_text(document.get("name")),
            vertex_types=tuple(
                VertexType(
                    name=_text(v.get("type_name")),
                    properties=_properties(v),
                    primary_keys=tuple(_text(k) for k in v.get("primary_keys") or ()),
                )
                for v in body.get("vertex_types") or ()
            ),
            edge_types=tuple(
                EdgeType(
                    name=_text(e.get("type_name")),
                    pairs=tuple(_pair(p) for p in e.get("vertex_type_pair_relations") or ()),
                    properties=_properties(e),
                )
                for e in body.get("edge_types") or ()
            ),
        )

    @staticmethod
    def from_yaml(text: str) -> GraphSchema:
        return GraphSchema.from_dict(_parse_yaml(text))

    @staticmethod
    def load(spark: SparkSession, path: str) -> GraphSchema:
        """Read the YAML from any Hadoop path."""
        return GraphSchema.from_yaml(_read_text(spark, path))


@dataclass(frozen=True)
class ColumnMapping:
    column: str
    property: str = ""
    index: int = 0


@dataclass(frozen=True)
class VertexMapping:
    label: str
    inputs: tuple[str, ...]
    columns: tuple[ColumnMapping, ...] = ()


@dataclass(frozen=True)
class EdgeMapping:
    triplet: Triplet
    inputs: tuple[str, ...]
    source: tuple[ColumnMapping, ...]
    destination: tuple[ColumnMapping, ...]
    columns: tuple[ColumnMapping, ...] = ()


@dataclass(frozen=True)
class DataSource:
    """Where the inputs live: ``file`` paths below ``location`` or catalog ``table`` names."""

    scheme: str
    location: str = ""
    format: str = ""
    options: Mapping[str, str] = field(default_factory=dict)

    @property
    def kind(self) -> str:
        # A scheme is written all in lower or all in upper case.
        for known in SCHEMES:
            if self.scheme in (known, known.upper()):
                return known
        raise SpecError(f"unknown source scheme {self.scheme!r}")

    @property
    def file_format(self) -> str:
        chosen = self.format or "csv"
        if chosen not in FILE_FORMATS:
            raise SpecError(f"file sources are {', '.join(FILE_FORMATS)}, not {chosen!r}")
        return chosen


@dataclass(frozen=True)
class ImportSpec:
    graph: str
    source: DataSource
    vertices: tuple[VertexMapping, ...]
    edges: tuple[EdgeMapping, ...] = ()
    import_option: str = "init"

    def vertex(self, label: str) -> VertexMapping:
        for mapping in self.vertices:
            if mapping.label == label:
                return mapping
        raise SpecError(f"vertex label {label!r} is not in the import mapping")

    def edge(self, triplet: Triplet) -> EdgeMapping:
        for mapping in self.edges:
            if mapping.triplet == triplet:
                return mapping
        raise SpecError(f"edge {triplet} is not in the import mapping")

    @property
    def save_mode(self) -> str:
        option = self.import_option or "init"
        if option == "init":
            return "errorifexists"
        if option == "overwrite":
            return "overwrite"
        raise SpecError(f"import option {option!r} is not supported (init, overwrite)")

    @staticmethod
    def from_dict(document: Mapping, scheme_aliases: Mapping[str, str] | None = None) -> ImportSpec:
        """Bind a mapping document.

        ``scheme_aliases`` lets an existing document keep its deployment's own
        scheme names, e.g. ``{"warehouse": "table", "bucket": "file"}``.
        """
        loading = document.get("loading_config") or {}
        source = loading.get("data_source") or {}
        fmt = loading.get("format") or {}
        scheme = _text(source.get("scheme"))
        kind = (scheme_aliases or {}).get(scheme, scheme)
        named = _text(fmt.get("type"))
        return ImportSpec(
            graph=_text(document.get("graph")),
            source=DataSource(
                scheme=kind,
                location=_text(source.get("location")),
                format=named,
                options={_text(k): _text(v) for k, v in (fmt.get("metadata") or {}).items()},
            ),
            import_option=_text(loading.get("import_option")) or "init",
            vertices=tuple(
                VertexMapping(
                    label=_text(m.get("type_name")),
                    inputs=_inputs(m),
                    columns=_columns(m.get("column_mappings")),
                )
                for m in document.get("vertex_mappings") or ()
            ),
            edges=tuple(
                EdgeMapping(
                    triplet=_triplet(m.get("type_triplet") or {}),
                    inputs=_inputs(m),
                    source=_columns(m.get("source_vertex_mappings")),
                    destination=_columns(m.get("destination_vertex_mappings")),
                    columns=_columns(m.get("column_mappings")),
                )
                for m in document.get("edge_mappings") or ()
            ),
        )

    @staticmethod
    def from_yaml(text: str, scheme_aliases: Mapping[str, str] | None = None) -> ImportSpec:
        return ImportSpec.from_dict(_parse_yaml(text), scheme_aliases)

    @staticmethod
    def load(spark: SparkSession, path: str, scheme_aliases: Mapping[str, str] | None = None) -> ImportSpec:
        """Read the YAML from any Hadoop path."""
        return ImportSpec.from_yaml(_read_text(spark, path), scheme_aliases)


@dataclass(frozen=True)
class FieldPlan:
    """One column of a label or triplet: where it comes from and what it becomes."""

    column: str
    name: str
    type: str
    index: int = 0


def vertex_fields(schema: GraphSchema, spec: ImportSpec, label: str, naming: str = "property") -> list[FieldPlan]:
    """Fields of a label in mapping order; all properties by name if nothing is mapped."""
    vertex = schema.vertex(label)
    mapping = spec.vertex(label)
    if not mapping.columns:
        return [_field(p.name, p, naming) for p in vertex.properties]
    return [_mapped(c, vertex.properties, f"label {label!r}", naming) for c in mapping.columns]


def endpoint_fields(
    schema: GraphSchema, spec: ImportSpec, triplet: Triplet, naming: str = "property"
) -> tuple[FieldPlan, FieldPlan]:
    """The two endpoint columns, typed like the keys of the labels they point to."""
    schema.edge(triplet)
    mapping = spec.edge(triplet)
    ends = []
    for side, columns, label in (
        ("src", mapping.source, triplet.source),
        ("dst", mapping.destination, triplet.destination),
    ):
        if len(columns) != 1:
            raise SpecError(f"edge {triplet} needs exactly one {side} column, has {len(columns)}")
        if not columns[0].column:
            raise SpecError(f"edge {triplet}: {side} column name is empty")
        name = side if naming == "property" else columns[0].column
        ends.append(FieldPlan(columns[0].column, name, schema.key(label).type, columns[0].index))
    if ends[0].column == ends[1].column:
        raise SpecError(f"edge {triplet}: both endpoints are read from column {ends[0].column!r}")
    return ends[0], ends[1]


def edge_property_fields(
    schema: GraphSchema, spec: ImportSpec, triplet: Triplet, naming: str = "property"
) -> list[FieldPlan]:
    """Fields of an edge's properties; the mapping is either empty or complete."""
    edge = schema.edge(triplet)
    mapping = spec.edge(triplet)
    if not mapping.columns:
        return [_field(p.name, p, naming) for p in edge.properties]
    if len(mapping.columns) != len(edge.properties):
        raise SpecError(
            f"edge {triplet} maps {len(mapping.columns)} columns but declares {len(edge.properties)} properties"
        )
    return [_mapped(c, edge.properties, f"edge {triplet}", naming) for c in mapping.columns]


def validate(schema: GraphSchema, spec: ImportSpec, naming: str = "property") -> None:
    """Raise ``SpecError`` for anything that can be known without reading data."""
    if naming not in ("property", "source"):
        raise SpecError(f"column naming is 'property' or 'source', not {naming!r}")
    if spec.source.kind == "file":
        spec.source.file_format
    spec.save_mode
    _no_repeats([m.label for m in spec.vertices], "vertex mapping")
    _no_repeats([m.triplet for m in spec.edges], "edge mapping")
    mapped = {m.label for m in spec.vertices}
    for mapping in spec.vertices:
        fields = vertex_fields(schema, spec, mapping.label, naming)
        key = schema.key(mapping.label)
        where = f"label {mapping.label!r}"
        if mapping.columns and key.name not in {c.property for c in mapping.columns}:
            raise SpecError(f"{where}: no column is mapped to the primary key {key.name!r}")
        _check_fields(fields, mapping.inputs, where)
    for mapping in spec.edges:
        fields = [
            *endpoint_fields(schema, spec, mapping.triplet, naming),
            *edge_property_fields(schema, spec, mapping.triplet, naming),
        ]
        _check_fields(fields, mapping.inputs, f"edge {mapping.triplet}", endpoints=2)
        for label in (mapping.triplet.source, mapping.triplet.destination):
            if label not in mapped:
                raise SpecError(f"edge {mapping.triplet}: label {label!r} is not loaded by the mapping")


def key_column(schema: GraphSchema, spec: ImportSpec, label: str, naming: str = "property") -> str:
    """Name of the key in the projected frame of a label."""
    key = schema.key(label)
    if naming == "property":
        return key.name
    for mapping in spec.vertex(label).columns:
        if mapping.property == key.name:
            return mapping.column
    if spec.vertex(label).columns:
        raise SpecError(f"label {label!r}: no column is mapped to the primary key {key.name!r}")
    return key.name


def find_property(properties: tuple[Property, ...], name: str, where: str) -> Property:
    for candidate in properties:
        if candidate.name == name:
            return candidate
    raise SpecError(f"{where} has no property {name!r}")


def _field(column: str, prop: Property, naming: str, index: int = 0) -> FieldPlan:
    return FieldPlan(column, prop.name if naming == "property" else column, prop.type, index)


def _mapped(mapping: ColumnMapping, properties: tuple[Property, ...], where: str, naming: str) -> FieldPlan:
    if not mapping.property:
        raise SpecError(f"{where}: a mapping names no property")
    if not mapping.column:
        raise SpecError(f"{where}: the mapping of {mapping.property!r} names no column")
    return _field(mapping.column, find_property(properties, mapping.property, where), naming, mapping.index)


def _check_fields(fields: list[FieldPlan], inputs: tuple[str, ...], where: str, endpoints: int = 0) -> None:
    if not inputs:
        raise SpecError(f"{where} has no input")
    for f in fields:
        spark_type(f.type)
    names = [f.name.lower() for f in fields]
    _no_repeats(names, f"column of {where}")
    clash = sorted(set(names[endpoints:]) & set(RESERVED))
    if clash:
        raise SpecError(f"{where}: property names {clash} are used by the engine; rename the properties")


def _no_repeats(values: list, what: str) -> None:
    repeated = sorted({str(v) for v in values if values.count(v) > 1})
    if repeated:
        raise SpecError(f"repeated {what}: {', '.join(repeated)}")


def _properties(document: Mapping) -> tuple[Property, ...]:
    return tuple(
        Property(_text(p.get("property_name")), _text((p.get("property_type") or {}).get("primitive_type")))
        for p in document.get("properties") or ()
    )


def _pair(document: Mapping) -> EdgePair:
    params = document.get("x_csr_params") or {}
    return EdgePair(
        source=_text(document.get("source_vertex")),
        destination=_text(document.get("destination_vertex")),
        relation=_text(document.get("relation")),
        out_only=_text(params.get("edge_storage_strategy")) == "ONLY_OUT",
    )


def _triplet(document: Mapping) -> Triplet:
    return Triplet(
        source=_text(document.get("source_vertex")),
        edge=_text(document.get("edge")),
        destination=_text(document.get("destination_vertex")),
    )


def _columns(documents: list | None) -> tuple[ColumnMapping, ...]:
    return tuple(
        ColumnMapping(
            column=_text((d.get("column") or {}).get("name")),
            property=_text(d.get("property")),
            index=int((d.get("column") or {}).get("index") or 0),
        )
        for d in documents or ()
    )


def _inputs(document: Mapping) -> tuple[str, ...]:
    return tuple(_text(i) for i in document.get("inputs") or ())


def _text(value: object) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value)


def _parse_yaml(text: str) -> Mapping:
    try:
        import yaml
    except ImportError as missing:
        raise SpecError("reading YAML needs the yaml module; use from_dict instead") from missing
    document = yaml.safe_load(text)
    if not isinstance(document, Mapping):
        raise SpecError("the document is not a mapping")
    return document


def _read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()["value"]
