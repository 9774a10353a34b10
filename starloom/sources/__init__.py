"""Readers. A path may be any URI Hadoop knows, a folder or a glob."""
