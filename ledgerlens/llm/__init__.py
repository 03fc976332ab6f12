"""Training-data operators: de-duplication, filtering, scoring, token counts, packing.

Each module holds one operator as plain functions from DataFrames to a
DataFrame; ``queries`` applies them to whole tables. Nothing else in the
library imports this subpackage.
"""
