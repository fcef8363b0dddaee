"""Readers that turn files, payloads, pages and topics into DataFrames."""
