"""Readers, writers and schemas."""

from revlens.sources.schemas import (  # noqa: F401
    COMMENT_SCHEMA, PRODUCT_SCHEMA, PRODUCT_JSON_SCHEMA, REVIEW_JSON_SCHEMA,
    LISTING_JSON_SCHEMA,
)
from revlens.sources.readers import (  # noqa: F401
    flatten_product_ids, flatten_products, flatten_reviews, read_csv,
    read_part_dir, read_stopwords, read_table,
)
from revlens.sources.sinks import (  # noqa: F401
    export_recommendations, export_rules, export_rules_named, load_rule_model,
    save_rule_model, write_csv, write_named_outputs, write_table,
)
