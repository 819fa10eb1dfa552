"""Road-camera pass analytics as DataFrame operators, for tables and for streams."""
