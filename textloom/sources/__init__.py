"""Readers and writers: text trees, marked records, judgements, tables, reports."""
