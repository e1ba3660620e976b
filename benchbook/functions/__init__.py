"""Text functions as column expressions, with Arrow UDFs where a regex does not suffice."""
