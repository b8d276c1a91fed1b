"""Lexiflow: a PySpark-native engine for building, patching, converting and
validating large nested lexical datasets."""
