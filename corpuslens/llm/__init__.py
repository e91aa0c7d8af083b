"""Training-data pipeline operators: dedup, packing, mixing, scoring, sharding.

Each module holds one operator with a general interface plus the thin
``opN_...`` query that applies it to a whole table.  Nothing outside this
package imports it.
"""
