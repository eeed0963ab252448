"""Refresh between watermarks: bounded batches driven by a change log."""

from tablehaul.streaming.incremental import (changed_keys, delta, in_window, incremental_load, incremental_load_partitions,
                                             new_watermark, partition_predicates, previous_watermark, previous_watermarks,
                                             record_watermark)

__all__ = ["changed_keys", "delta", "in_window", "incremental_load", "incremental_load_partitions", "new_watermark",
           "previous_watermark", "previous_watermarks", "record_watermark"]
