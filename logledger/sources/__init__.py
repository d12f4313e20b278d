"""Readers (files, tables, formats) and renderers of the original input layouts."""
