"""Texts that must read exactly as the contract states them.

They are kept together here, in the order the pipeline meets them.
"""

# Source ingest.
INVALID_JSON = "Invalid JSON at {file}:{line}"

# Labelling policy and preconditions.
THRESHOLD_RANGE = "positive_rating_threshold must be between 1.0 and 5.0."
LABEL_MISSING_COLUMNS = "Interactions cannot be labeled; missing columns: {columns}."

# Validation rules: check name -> (order, severity, dataset, message).
RULES = {
    "null_required_values": (1, "error", "interactions", "Required values are null."),
    "rating_range": (2, "error", "interactions", "Ratings must be between 1.0 and 5.0."),
    "timestamp_range": (3, "error", "interactions", "Timestamps must be positive Unix milliseconds."),
    "duplicate_events": (4, "error", "interactions", "Duplicate user-item-timestamp events are not allowed."),
    "null_item_ids": (6, "error", "items", "Item IDs cannot be null."),
    "duplicate_item_ids": (7, "error", "items", "Item IDs must be unique."),
    "missing_item_text": (8, "warning", "items", "Items without text cannot receive content-based recommendations."),
    "interaction_item_join": (9, "error", "cross_dataset", "Every interaction item must exist in the item dataset."),
}
REQUIRED_COLUMNS = "Missing required columns: {columns}."
VALIDATION_FAILED = "Processed data validation failed."

# Index encoding.
NULL_IDENTIFIERS = "Cannot fit an encoder with null identifiers."
ENCODER_MISSING_COLUMNS = "Cannot fit encoders; missing columns: {columns}."
NOT_FITTED = "Encoder has not been fitted."

# Exploration.
DEFAULT_TITLE = "Untitled product"

# Own texts (no counterpart in the contract).
NO_ROW_ORDER = "first-seen order needs row order columns: pass order=[...]"
INDEX_TOO_LARGE = "more distinct identifiers than an INT index can number"
