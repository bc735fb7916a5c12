"""Column expressions. All run inside the JVM except HTML unescaping (one Arrow UDF)."""
