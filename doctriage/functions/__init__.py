"""Column -> Column expressions: confidence semantics, paths and globs, text and prompt, result records,
and the Arrow UDF that finds the JSON answer in free text."""
