"""Scans."""
