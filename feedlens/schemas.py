"""Explicit schemas (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

from .fixed import ANALYSIS_RECORD_FIELD, ANALYSIS_SENTIMENT_FIELD

S, L, D = T.StringType(), T.LongType(), T.DoubleType()

RAW_COMMENT_SCHEMA = T.StructType([
    T.StructField("content_id", S), T.StructField("content_name", S),
    T.StructField("comment", S), T.StructField("comment_date", S),
])

TAGGED_FILE_SCHEMA = T.StructType(RAW_COMMENT_SCHEMA.fields + [
    T.StructField("ordinal", L),
    T.StructField("predicted_sentiment", S),
    T.StructField("actual_sentiment", S),
])

LANG_CANDIDATE = T.StructType([T.StructField("langCode", S), T.StructField("langScore", D)])

USAGE_STRUCT = T.StructType([
    T.StructField("input", L), T.StructField("output", L),
    T.StructField("thinking", L), T.StructField("total", L),
])

# The model's answer object as written on disk upstream (key names with spaces).
ANALYSIS_JSON_STRUCT = T.StructType([
    T.StructField("Issue Category", S), T.StructField("Strength Category", S),
    T.StructField("Root Cause", S), T.StructField("Recommended Actions", T.ArrayType(S)),
    T.StructField("Owner", S), T.StructField("Priority", S),
    T.StructField("Error", S), T.StructField("Raw Output", S),
])

ANALYSIS_FILE_SCHEMA = T.StructType(RAW_COMMENT_SCHEMA.fields + [
    T.StructField(ANALYSIS_SENTIMENT_FIELD, S),
    T.StructField(ANALYSIS_RECORD_FIELD, ANALYSIS_JSON_STRUCT),
])

ACTION_ITEM = T.StructType([
    T.StructField("action", S), T.StructField("owner", S), T.StructField("priority", S),
    T.StructField("expected_impact", S),
])

NEGATIVE_SUMMARY_SCHEMA = T.StructType([
    T.StructField("total_negative_comments", L),
    T.StructField("grouped_summary", T.StructType([
        T.StructField("major_issues_summary", T.ArrayType(S)),
        T.StructField("minor_issues_summary", T.ArrayType(S)),
    ])),
    T.StructField("top_priority_actions", T.ArrayType(T.StructType([
        T.StructField("action", S), T.StructField("category", S), T.StructField("owner", S),
        T.StructField("priority", S),
    ]))),
    T.StructField("category_summaries", T.ArrayType(T.StructType([
        T.StructField("category", S), T.StructField("count", L), T.StructField("percent_of_negative", D),
        T.StructField("tier", S), T.StructField("key_themes", T.ArrayType(S)), T.StructField("urgency", S),
        T.StructField("action_items", T.ArrayType(ACTION_ITEM)),
    ]))),
])

POSITIVE_SUMMARY_SCHEMA = T.StructType([
    T.StructField("total_positive_comments", L),
    T.StructField("grouped_summary", T.StructType([T.StructField("strengths_summary", T.ArrayType(S))])),
    T.StructField("top_strengths", T.ArrayType(S)),
    T.StructField("category_summaries", T.ArrayType(T.StructType([
        T.StructField("category", S), T.StructField("count", L), T.StructField("percent_of_positive", D),
        T.StructField("tier", S), T.StructField("key_themes", T.ArrayType(S)),
        T.StructField("amplification_suggestion", S),
        T.StructField("action_items", T.ArrayType(ACTION_ITEM)),
    ]))),
])
