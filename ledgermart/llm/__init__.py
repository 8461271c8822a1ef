"""Operators of a training-data pipeline: rules, joins, samplers and encoders over text tables.

Each module holds one operator with its general interface, the thin query ``opN_<name>`` that
applies it to a whole table, and, where SQL can say the same, the SQL text.  Nothing outside this
package imports it.
"""
