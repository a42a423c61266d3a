"""Shelfmark: a retail lakehouse built from plain PySpark DataFrame functions.

Layers: raw -> staging -> star -> warehouse. Every transform is a
``DataFrame -> DataFrame`` function on built-in expressions, usable with
``df.transform(...)``; reading and writing sit in ``sources`` and ``sinks``.
"""
