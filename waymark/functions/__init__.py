"""Part of the waymark package."""
