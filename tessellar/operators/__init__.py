"""Tiling operators over feature tables and manifests."""
