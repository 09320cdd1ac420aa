"""Column-expression helpers.  Everything here returns a ``Column`` built from
built-in functions, so it runs inside whole-stage codegen — no Python UDFs."""
