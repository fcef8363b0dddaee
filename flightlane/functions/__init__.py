"""Column expressions; all of them run inside the JVM except HTML entity decoding."""
