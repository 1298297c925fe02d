"""Reading raw files and lookups; reading and writing the layers."""
