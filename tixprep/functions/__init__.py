"""Column-expression builders (pure ``Column -> Column``), all JVM-side."""
