"""Column-expression builders: everything here stays JVM-side and codegen'd."""
