"""

Import from here to switch call sites over: every name takes and returns
DataFrames (or writes tables) instead of in-memory pandas objects.
"""

from feedloom.functions.text import item_text, join_text, normalise_ws as normalised_text
from feedloom.functions.time import iso_utc_from_ms as timestamp_to_iso
from feedloom.operators.clean import (cast_failures, clean_interactions, clean_items, item_cast_failures,
                                      preprocessing_summary)
from feedloom.operators.explore import (active_period, dataset_summary, rating_counts, round_summary, top_items,
                                        user_activity_histogram as activity_histogram)
from feedloom.operators.index import (UNKNOWN_INDEX, apply_index, encode_interactions, fit_encoders, fit_index,
                                      index_size, invert_index, load_mapping, save_mapping)
from feedloom.operators.label import LabelPolicy, label_interactions as label, label_summary
from feedloom.operators.profile import (join_coverage, metadata_missing_fields, profile_metadata, profile_reviews,
                                        raw_rating_histogram, review_missing_fields)
from feedloom.operators.validate import gate, referential_orphans, validation_findings as validate, validation_report
from feedloom.plans.build import build_tables, explore, fit_and_encode, gate_and_label, profile_sources
from feedloom.sources.audit import source_audit
from feedloom.sources.jsonl import ingest_records, metadata_records, quarantine, read_records, review_records
from feedloom.sources.sinks import read_table, write_labeled, write_summary

__all__ = [name for name in dir() if not name.startswith("_")]
