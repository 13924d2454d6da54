"""Column-to-column functions; all run inside whole-stage codegen."""
