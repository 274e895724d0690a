"""Document tables: write operations by id, and bulk lines for a document store."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from chondria.functions.names import encode_columns

OPERATIONS = ("index", "create", "update", "upsert")
_UNSUPPORTED = (T.MapType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


def _check_operation(operation: str) -> None:
    if operation not in OPERATIONS:
        raise ValueError(f"unknown write operation {operation!r}; known: {', '.join(OPERATIONS)}")


def _check_types(kind: T.DataType, path: str) -> None:
    if isinstance(kind, _UNSUPPORTED):
        raise NotImplementedError(f"{path}: {kind.simpleString()} has no document form")
    if isinstance(kind, T.StructType):
        for f in kind:
            _check_types(f.dataType, f"{path}.{f.name}" if path else f.name)
    elif isinstance(kind, T.ArrayType):
        _check_types(kind.elementType, path)


def apply_documents(stored: DataFrame, incoming: DataFrame, doc_id: str, operation: str = "index",
                    ignore_errors: bool = False) -> DataFrame:
    """``stored`` after writing ``incoming``, both with one row per ``doc_id``.

    ``index`` replaces whole documents or adds them; ``create`` adds, and an existing id is an error; ``update``
    overwrites fields of existing documents, NULLs included, and an unknown id is an error; ``upsert`` updates or
    adds. ``ignore_errors`` skips the failing documents.
    """
    _check_operation(operation)
    fields = [c for c in dict.fromkeys(stored.columns + incoming.columns) if c != doc_id]
    old = stored.select(doc_id, F.struct(*[c for c in stored.columns if c != doc_id]).alias("_old"))
    new = incoming.select(doc_id, F.struct(*[c for c in incoming.columns if c != doc_id]).alias("_new"))
    both = old.join(new, doc_id, "full")
    has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    wrong = {"create": has_old & has_new, "update": has_new & ~has_old}.get(operation)
    if wrong is not None and not ignore_errors:
        message = F.concat(F.lit(f"{operation}: document "), F.col(doc_id).cast("string"),
                           F.lit(" exists" if operation == "create" else " does not exist"))
        both = both.withColumn("_old", F.when(wrong, F.raise_error(message)).otherwise(F.col("_old")))
    if operation == "update":
        both = both.filter(has_old)
    takes_new = has_new & ~has_old if operation == "create" else has_new

    def value(name: str) -> Column:
        before = F.col("_old")[name] if name in stored.columns else F.lit(None)
        if name not in incoming.columns:
            kept = F.when(~takes_new, before) if operation == "index" else before
            return kept.alias(name)
        return F.when(takes_new, F.col("_new")[name]).otherwise(before).alias(name)
    return both.select(doc_id, *[value(f) for f in fields])


def bulk_lines(df: DataFrame, index: str, doc_id: str | None = None, operation: str = "index",
               dot: str | None = "_") -> DataFrame:
    """One ``value`` per row holding the action line and the document line of a bulk request.

    Field names are encoded. NULL fields are omitted by ``index`` and ``create`` and written by ``update`` and
    ``upsert``, where they must overwrite.
    """
    _check_operation(operation)
    _check_types(df.schema, "")
    named = encode_columns(df, dot)
    writes_null = operation in ("update", "upsert")
    body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in named.columns]),
                     {"ignoreNullFields": "false" if writes_null else "true"})
    if writes_null:
        extra = ',"doc_as_upsert":true' if operation == "upsert" else ""
        body = F.concat(F.lit('{"doc":'), body, F.lit(extra + "}"))
    parts = [F.lit(index).alias("_index")]
    if doc_id:
        renamed = named.columns[df.columns.index(doc_id)]
        parts.append(F.col(f"`{renamed}`").cast("string").alias("_id"))
    action = F.to_json(F.struct(F.struct(*parts).alias("update" if writes_null else operation)))
    return named.select(F.concat(action, F.lit("\n"), body).alias("value"))
