"""Scans: trip tables, zone dimensions, page tables, schema inspection."""
