"""Budget documents: one JSON document per scrape, with one array per kind of entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StructType

from tallyhouse.sources.lake import BUDGET_SOURCE, read_json_snapshots

# Fields of the public budget API that the staging models use.
BUDGET_FIELDS = "id string, name string, last_modified_on string"
CURRENCY = "currency_format struct<iso_code string, currency_symbol string>"
ENTITIES = {
    "accounts": "id string, name string, type string, on_budget boolean, closed boolean, deleted boolean,"
    " transfer_payee_id string, last_reconciled_at string",
    "payees": "id string, name string, transfer_account_id string, deleted boolean",
    "category_groups": "id string, name string, hidden boolean, deleted boolean",
    "months": "month string, categories array<struct<id string, category_group_id string, name string,"
    " budgeted bigint, goal_type string, goal_target bigint, goal_target_month string, deleted boolean>>",
    "transactions": "id string, date string, amount bigint, memo string, cleared string, approved boolean,"
    " account_id string, payee_id string, category_id string, transfer_account_id string,"
    " matched_transaction_id string, deleted boolean",
    "subtransactions": "id string, transaction_id string, amount bigint, memo string, payee_id string,"
    " category_id string, transfer_account_id string, deleted boolean",
}


def document_schema(*entities: str) -> str:
    """Schema of a document reduced to the named entity arrays.

    JSON files are row-wise: a reduced schema is the only way to keep the parser from
    building the arrays a model does not read.
    """
    arrays = [f"{name} array<struct<{ENTITIES[name]}>>" for name in entities]
    budget = ", ".join([BUDGET_FIELDS, CURRENCY, *arrays])
    return f"data struct<budget struct<{budget}>, server_knowledge bigint>"


def read_budget(
    spark: SparkSession, root: str, *entities: str, source: str = BUDGET_SOURCE, lines: bool = False
) -> DataFrame:
    return read_json_snapshots(spark, root, document_schema(*entities), source, lines)


# What is wrong with a document that is put aside
UNREADABLE, NO_BUDGET = "does not parse", "has no budget id"


def read_raw(spark: SparkSession, root: str, source: str = BUDGET_SOURCE, lines: bool = False) -> DataFrame:
    """Documents as text (value, date, file): one per file, or one per line."""
    reader = spark.read.option("wholetext", not lines).option("basePath", root)
    return reader.text(f"{root}/by={source}").select("value", "date", F.col("_metadata.file_path").alias("file"))


def checked(raw: DataFrame, *entities: str) -> DataFrame:
    """(data, date, file, value, reason) of every document that is not blank.

    ``reason`` is NULL for a sound document. A document is at fault if it is no JSON, if a value
    that the schema reads has another type, or if it belongs to no budget.
    """
    schema = f"{document_schema(*entities)}, _corrupt string"
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    reason = F.when(F.col("doc").isNull() | F.col("doc._corrupt").isNotNull(), UNREADABLE).when(
        F.col("doc.data.budget.id").isNull(), NO_BUDGET
    )
    rows = raw.filter(F.trim("value") != "").withColumn("doc", parsed)
    return rows.select("doc.data", "date", "file", "value", reason.alias("reason"))


def sound(documents: DataFrame) -> DataFrame:
    """Checked documents that the staging models can read."""
    return documents.filter("reason is null").select("data", "date")


def quarantine(documents: DataFrame) -> DataFrame:
    """Checked documents at fault, as they came, with the reason and the file."""
    return documents.filter("reason is not null").select("date", "file", "reason", "value")


def unknown_fields(raw: DataFrame, *entities: str) -> DataFrame:
    """(field, n_documents) of fields that documents hold and no model knows.

    Looks at the budget itself and at the entries of the named arrays; the parser would skip such
    fields without a word.
    """
    whole = StructType.fromDDL(document_schema(*ENTITIES))["data"].dataType["budget"].dataType
    fields = [(F.json_object_keys(F.get_json_object("value", "$.data.budget")), "", whole)]
    for name in entities:
        entries = F.from_json(F.get_json_object("value", f"$.data.budget.{name}"), "array<map<string,string>>")
        keys = F.array_distinct(F.flatten(F.transform(entries, F.map_keys)))
        kind = whole[name].dataType
        fields.append((keys, f"{name}.", kind.elementType if isinstance(kind, ArrayType) else kind))

    def unknown_of(keys: Column, prefix: str, known: StructType) -> Column:
        others = F.array_except(F.coalesce(keys, F.array().cast("array<string>")), F.array(*map(F.lit, known.names)))
        return F.transform(others, lambda key: F.concat(F.lit(prefix), key))

    unknown = F.concat(*(unknown_of(*field) for field in fields))
    return raw.select(F.explode(unknown).alias("field")).groupBy("field").agg(F.count("*").alias("n_documents"))
