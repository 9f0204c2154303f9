"""Column-expression building blocks: analyzers, text helpers, scoring."""
