"""Column names, fixed orders and schemas of the tables between the steps."""

from __future__ import annotations

from pyspark.sql import types as T

ROW_ID = "source_row_id"
ARTICLE_ID = "article_id"
TITLE = "title"
TEXT = "text"
LABEL = "label"
CONTENT_KEY = "content_key"
READ_POSITION = "read_position"

# The label domain and its class names.
LABELS = (0, 1)
CLASS_NAMES = {0: "real", 1: "fake"}

# What a raw table must have, and its columns.
REQUIRED_COLUMNS = (TITLE, TEXT, LABEL)

RAW_SCHEMA = T.StructType(
    [
        T.StructField(ROW_ID, T.LongType()),
        T.StructField(TITLE, T.StringType()),
        T.StructField(TEXT, T.StringType()),
        T.StructField(LABEL, T.IntegerType()),
    ]
)

# Column names and orders of the handoff tables.
STAGE1_COLUMNS = [
    ROW_ID,
    TITLE,
    TEXT,
    LABEL,
    "class_name",
    "title_missing",
    "text_missing",
    "complete_case",
]
MASTER_COLUMNS = [ARTICLE_ID, *STAGE1_COLUMNS]
GENERATED_COLUMNS = [
    "raw_title_body",
    "clean_title_with_markers",
    "clean_body_with_markers",
    "clean_title_body_with_markers",
    "clean_title",
    "clean_body",
    "clean_title_body",
    "clean_title_word_count",
    "clean_body_word_count",
    "clean_combined_word_count",
]
CLEANED_COLUMNS = [
    ARTICLE_ID,
    ROW_ID,
    "row_id",
    *STAGE1_COLUMNS[1:],
    *GENERATED_COLUMNS,
]
# Columns of the samples before and after cleaning.
SAMPLE_COLUMNS = [
    ARTICLE_ID,
    "row_id",
    LABEL,
    "class_name",
    TITLE,
    "clean_title",
    TEXT,
    "clean_body",
    "clean_title_body",
]

# Parts of the split, input settings of the feature step.
SPLITS = ("train", "val", "test")
INPUT_SETTINGS = {
    "title": "clean_title",
    "body": "clean_body",
    "combined": "clean_title_body",
}
