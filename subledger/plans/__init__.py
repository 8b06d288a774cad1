"""The derived tables, layer by layer. Every function takes DataFrames and returns one."""
