"""SQL expressions shared by the layers.

They are plain expression text: it reads like the rule it states, parses once
in the JVM, and compiles into the same plan as column objects would.
"""
