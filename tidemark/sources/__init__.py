from tidemark.sources.contracts import INPUTS, TABLE_ATTRIBUTES, TARGETS, empty_target
from tidemark.sources.readers import read_inputs, read_target

__all__ = ["INPUTS", "TABLE_ATTRIBUTES", "TARGETS", "empty_target", "read_inputs", "read_target"]
