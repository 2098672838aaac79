"""Operators of a training-data pipeline: formatting, mixing, deduplication,
language and quality models, decontamination and token output.

Each module holds one operator with a general interface; ``queries`` binds the
operators to the tables of a data folder. Nothing outside this subpackage
imports it.
"""
