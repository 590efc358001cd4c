"""Column functions: pure expressions that stay inside whole-stage codegen."""
