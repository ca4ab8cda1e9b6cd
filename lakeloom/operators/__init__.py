"""Operators: DataFrame -> DataFrame building blocks (transforms, marts, profilers, table sets)."""
