"""Source readers (S1-S8) and driver-table adapters."""

from tallyspark.sources.readers import (ACTIVITY_SCHEMA, PRICES_SCHEMA, REWARDS_SCHEMA,
                                        TRANSACTIONS_SCHEMA, Sources, load_source_tables,
                                        read_json_bodies, read_source)
from tallyspark.sources.mapping import MAPPING_ROWS, mapping_df

__all__ = ["Sources", "load_source_tables", "ACTIVITY_SCHEMA", "PRICES_SCHEMA", "REWARDS_SCHEMA", "TRANSACTIONS_SCHEMA",
           "read_source", "read_json_bodies", "MAPPING_ROWS", "mapping_df"]
