"""Readers of exported files and of landed API replies.

A landing folder holds one reply per line. Schemas are declared, so a read
never scans the data to infer one.
"""
