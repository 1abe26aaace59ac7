"""Names: quoting, and the two names a staged table goes by."""

from __future__ import annotations


def quote(name: str) -> str:
    """One column or table identifier, quoted for Spark SQL."""
    return "`" + name.replace("`", "``") + "`"


def flat_name(table_name: str) -> str:
    """A table name without dots, for stores that know one level only."""
    return table_name.replace(".", "_")


def staged_name(dataset: str, table_name: str) -> str:
    """Where a staged copy is kept: ``dataset.db_table``."""
    return f"{dataset}.{flat_name(table_name)}"


def document_field(dataset: str, table_name: str) -> str:
    """The root field a document client asks for: ``dataset_db_table``."""
    return f"{dataset}_{flat_name(table_name)}"
