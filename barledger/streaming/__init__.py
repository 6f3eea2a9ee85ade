"""The price audit over files as they land."""
