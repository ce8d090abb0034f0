"""Larkspur: a PySpark-native engine for discussion archives and their daily series."""
