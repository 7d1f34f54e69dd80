"""Training-data operators: dedup, decontamination, filtering, counting and
mixing of document tables. Nothing else in the package imports this one."""
