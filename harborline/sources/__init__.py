"""Landed payloads -> envelope rows.

A source is a function `(landed DataFrame, options) -> envelope DataFrame`;
anything of that shape, including a Python Data Source read, plugs in.
"""
