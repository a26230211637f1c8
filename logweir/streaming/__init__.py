"""The same load as a continuous query per source."""
