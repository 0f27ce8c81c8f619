"""Logical schema, its mapping to physical names, and the shared settings."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Logical columns of the three tables and their types.
CHATS = {
    "chatting_pk": "bigint",
    "input_text": "string",
    "created_at": "timestamp_ntz",
}
KEYWORDS = {
    "query_text": "string",
    "keyword": "string",
    "category_id": "int",
    "query_count": "bigint",
    "created_at": "timestamp_ntz",
    "batch_created_at": "timestamp_ntz",
}
CATEGORIES = {
    "category_id": "int",
    "category_name": "string",
}

# Names tried, in this order, for the question column of the fact table.
QUERY_COLUMN_PRIORITY = ("query_text", "content", "question", "text")


@dataclass(frozen=True)
class Settings:
    """Values every operator agrees on."""

    default_category_id: int = 11
    default_category_name: str = "기타"
    max_keyword_length: int = 100


DEFAULTS = Settings()


@dataclass(frozen=True)
class SchemaConfig:
    """Physical table and column names; anything not named keeps its logical name."""

    chats_table: str = "chattings"
    keywords_table: str = "admin_chat_keywords"
    categories_table: str = "admin_categories"
    columns: dict[str, str] = field(default_factory=dict)
    collation: str | None = None

    def physical(self, logical: str) -> str:
        return self.columns.get(logical, logical)

    def select_list(self, schema: dict[str, str]) -> list[Column]:
        """One typed, renamed column per logical column, so scans stay pruned."""
        out = []
        for name, dtype in schema.items():
            col = F.col(f"`{self.physical(name)}`").cast(dtype)
            if self.collation and name in ("input_text", "query_text", "keyword"):
                col = F.collate(col, self.collation)
            out.append(col.alias(name))
        return out


def normalize(df: DataFrame, schema: dict[str, str], cfg: SchemaConfig = SchemaConfig()) -> DataFrame:
    """Physical names to logical names and types; drops every other column."""
    return df.select(*cfg.select_list(schema))


def denormalize(df: DataFrame, schema: dict[str, str], cfg: SchemaConfig = SchemaConfig()) -> DataFrame:
    """Logical names back to physical names, for sinks."""
    return df.select(*[F.col(name).alias(cfg.physical(name)) for name in schema])


def binary(text: str) -> Column:
    """The text without a collation: what word rules, regular expressions and stored rows use."""
    return F.collate(F.col(text), "UTF8_BINARY")


def resolve_query_column(columns: list[str]) -> str:
    """Name of the question column: by priority, else the second column, else the first."""
    for name in QUERY_COLUMN_PRIORITY:
        if name in columns:
            return name
    return columns[1] if len(columns) > 1 else columns[0]
