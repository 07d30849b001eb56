"""Raw payloads to RSVP records, with bad messages kept aside rather than lost."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnout.schema import OPTIONAL, REPEATED, REQUIRED, RSVP_FIELDS, RSVP_SCHEMA_RELAXED

MESSAGE_NAME = "turnout.Rsvp"
MODES = ("PERMISSIVE", "FAILFAST")

DECODED_SCHEMA = T.StructType().add("rsvp", RSVP_SCHEMA_RELAXED).add("corrupt", T.BinaryType())


def descriptor_set() -> bytes:
    """The wire contract as a serialized protobuf ``FileDescriptorSet``."""
    from google.protobuf import descriptor_pb2

    field_proto = descriptor_pb2.FieldDescriptorProto
    labels = {
        REQUIRED: field_proto.LABEL_REQUIRED,
        OPTIONAL: field_proto.LABEL_OPTIONAL,
        REPEATED: field_proto.LABEL_REPEATED,
    }
    scalars = {"string": field_proto.TYPE_STRING, "double": field_proto.TYPE_DOUBLE}

    def describe(message, fields, full_name):
        for name, number, label, kind in fields:
            field = message.field.add(name=name, number=number, label=labels[label])
            if isinstance(kind, list):
                nested = message.nested_type.add(name=name.title().replace("_", ""))
                field.type = field_proto.TYPE_MESSAGE
                field.type_name = f".{full_name}.{nested.name}"
                describe(nested, kind, f"{full_name}.{nested.name}")
            else:
                field.type = scalars[kind]

    package, top = MESSAGE_NAME.split(".")
    files = descriptor_pb2.FileDescriptorSet()
    file = files.file.add(name="rsvp.proto", package=package, syntax="proto2")
    describe(file.message_type.add(name=top), RSVP_FIELDS, MESSAGE_NAME)
    return files.SerializeToString()


def _check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}: {mode!r}")


def decode_payload(
    df: DataFrame, col: str = "value", mode: str = "PERMISSIVE", use_jar: bool = False
) -> DataFrame:
    """Decode protobuf bytes into ``rsvp`` (a struct) and ``corrupt`` (the bytes that failed).

    A message that cannot be parsed or lacks a required field gets a null ``rsvp`` and its bytes
    in ``corrupt``; with ``FAILFAST`` it fails the job. Text that is not UTF-8 is kept, with
    replacement characters, as protobuf's JVM runtime does for proto2.

    ``use_jar`` decodes inside the JVM and needs Spark's protobuf module on the class path;
    otherwise Arrow batches go through Python. Decoding is row-local, so it needs no shuffle; decode once and store columns where several
    jobs read the same messages (``streaming.start_ingest``).
    """
    _check_mode(mode)
    if use_jar:
        from pyspark.sql.protobuf.functions import from_protobuf

        record = from_protobuf(
            F.col(col), MESSAGE_NAME, options={"mode": mode}, binaryDescriptorSet=descriptor_set()
        )
        return _parsed_once(df, col, record).select(
            F.col("record").alias("rsvp"),
            F.when(F.col("record").isNull(), F.coalesce("_payload", F.lit(b""))).alias("corrupt"),
        )
    return df.select(col).mapInArrow(_arrow_decoder(mode == "FAILFAST"), DECODED_SCHEMA)


def _arrow_decoder(failfast: bool):
    """Task function over Arrow batches. It captures plain values only, so workers need not
    have this package installed."""
    contract, name, fields = descriptor_set(), MESSAGE_NAME, RSVP_FIELDS

    def decode(batches):
        import pyarrow as pa
        from google.protobuf import descriptor_pb2, descriptor_pool, message, message_factory

        pool = descriptor_pool.DescriptorPool()
        for file in descriptor_pb2.FileDescriptorSet.FromString(contract).file:
            pool.Add(file)
        message_class = message_factory.GetMessageClass(pool.FindMessageTypeByName(name))
        scalars = {"string": pa.string(), "double": pa.float64()}

        def parse(payload):
            record = message_class()
            try:
                record.ParseFromString(payload)
                if record.IsInitialized():
                    return record
                raise ValueError(f"missing required fields: {record.FindInitializationErrors()}")
            except (message.DecodeError, ValueError, TypeError):
                if failfast:
                    raise
                return None

        def arrow_type(kind, label=None):
            if isinstance(kind, list):
                kind = pa.struct([(field, arrow_type(k, part)) for field, _, part, k in kind])
            else:
                kind = scalars[kind]
            return pa.list_(kind) if label == "repeated" else kind

        def column(records, kind):
            """One Arrow column for values that share a type; a missing value is None."""
            if not isinstance(kind, list):
                try:
                    return pa.array(records, type=scalars[kind])
                except pa.ArrowInvalid:  # text that is not UTF-8 comes as bytes
                    texts = [
                        value.decode(errors="replace") if isinstance(value, bytes) else value
                        for value in records
                    ]
                    return pa.array(texts, type=scalars[kind])
            missing = [record is None for record in records]
            if all(missing):
                return pa.nulls(len(records), arrow_type(kind))
            parts = []
            for field, _, label, part in kind:
                if label == "repeated":
                    lists = [() if record is None else getattr(record, field) for record in records]
                    ends = [0]
                    for entries in lists:
                        ends.append(ends[-1] + len(entries))
                    items = [item for entries in lists for item in entries]
                    parts.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), column(items, part)))
                    continue
                if label == "optional":
                    values = [
                        getattr(record, field) if record is not None and record.HasField(field) else None
                        for record in records
                    ]
                else:
                    values = [None if record is None else getattr(record, field) for record in records]
                parts.append(column(values, part))
            entries = [pa.field(field, arrow_type(part, label)) for field, _, label, part in kind]
            return pa.StructArray.from_arrays(parts, fields=entries, mask=pa.array(missing))

        for batch in batches:
            payloads = batch.column(0).to_pylist()
            records = [parse(payload) for payload in payloads]
            rejects = [
                None if record is not None else payload or b""
                for record, payload in zip(records, payloads)
            ]
            yield pa.RecordBatch.from_arrays(
                [column(records, fields), pa.array(rejects, type=pa.binary())], names=["rsvp", "corrupt"]
            )

    return decode


def encode_payload(rsvps: DataFrame) -> DataFrame:
    """The inverse of ``decode_payload``: wire-form RSVPs to protobuf bytes in ``value``."""
    contract, name, fields = descriptor_set(), MESSAGE_NAME, RSVP_FIELDS

    def encode(batches):
        import pyarrow as pa
        from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

        pool = descriptor_pool.DescriptorPool()
        for file in descriptor_pb2.FileDescriptorSet.FromString(contract).file:
            pool.Add(file)
        message_class = message_factory.GetMessageClass(pool.FindMessageTypeByName(name))

        def fill(records, columns, level):
            """Set the fields of ``level`` in all records, one Arrow column at a time."""
            for field, _, label, kind in level:
                column = columns[field]
                if label == "repeated":
                    sizes = column.value_lengths().fill_null(0).to_pylist()
                    items = [getattr(r, field).add() for r, size in zip(records, sizes) for _ in range(size)]
                    fill(items, by_name(column.flatten()), kind)
                elif isinstance(kind, list):
                    column_set = column.is_valid()
                    chosen = [r for r, is_set in zip(records, column_set.to_pylist()) if is_set]
                    nested = [getattr(r, field) for r in chosen]
                    for record in nested:
                        record.SetInParent()
                    fill(nested, by_name(column.filter(column_set)), kind)
                else:
                    for record, value in zip(records, column.to_pylist()):
                        if value is not None:
                            setattr(record, field, value)

        def by_name(structs):
            return dict(zip((part.name for part in structs.type), structs.flatten()))

        for batch in batches:
            records = [message_class() for _ in range(batch.num_rows)]
            fill(records, dict(zip(batch.schema.names, batch.columns)), fields)
            payloads = [record.SerializePartialToString() for record in records]
            yield pa.RecordBatch.from_arrays([pa.array(payloads, type=pa.binary())], names=["value"])

    return rsvps.select(*RSVP_SCHEMA_RELAXED.names).mapInArrow(encode, "value binary")


def _parsed_once(df: DataFrame, col: str, parsed: Column) -> DataFrame:
    """The payload and its ``record``. The generator yields one row per message and keeps later
    filters above it, where they read the parsed value; pushed below a plain projection they
    would parse again."""
    return df.select(
        F.col(col).cast("binary").alias("_payload"), F.explode_outer(F.array(parsed)).alias("record")
    )


def _lacks_required(record: Column, fields=RSVP_FIELDS) -> Column:
    """Whether a parsed record misses a field that the wire contract requires."""
    lacks = F.lit(False)
    for name, _, label, kind in fields:
        value = record.getField(name)
        if label == REQUIRED:
            lacks = lacks | value.isNull()
        if isinstance(kind, list):
            check = partial(_lacks_required, fields=kind)
            inner = F.exists(value, lambda item: check(item)) if label == REPEATED else check(value)
            lacks = lacks | (value.isNotNull() & inner)
    return lacks


def decode_json(df: DataFrame, col: str = "value", mode: str = "PERMISSIVE") -> DataFrame:
    """Like ``decode_payload`` for JSON text, entirely with built-in expressions."""
    _check_mode(mode)
    schema = T.StructType([*RSVP_SCHEMA_RELAXED, T.StructField("_broken", T.StringType())])
    parsed = F.from_json(F.col(col).cast("string"), schema, {"columnNameOfCorruptRecord": "_broken"})
    records = _parsed_once(df, col, parsed)
    record = F.col("record")
    bad = record.isNull() | record.getField("_broken").isNotNull() | _lacks_required(record)
    if mode == "FAILFAST":
        failed = F.raise_error(F.concat(F.lit("cannot decode RSVP: "), F.col("_payload").cast("string")))
    else:
        failed = F.lit(None)
    return records.select(
        F.when(~bad, record.dropFields("_broken")).otherwise(failed).alias("rsvp"),
        F.when(bad, F.coalesce("_payload", F.lit(b""))).alias("corrupt"),
    )


def decoded_rsvps(decoded: DataFrame) -> DataFrame:
    """The good records of a decoded frame, as RSVP columns in wire form."""
    return decoded.where(F.col("rsvp").isNotNull()).select("rsvp.*")


def quarantined(decoded: DataFrame) -> DataFrame:
    """The bytes of the messages that could not be decoded."""
    return decoded.where(F.col("corrupt").isNotNull()).select("corrupt")
