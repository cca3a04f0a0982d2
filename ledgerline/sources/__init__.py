"""Inputs: Parquet table reads, the bindings from driver tables to logical inputs, and table sinks."""
