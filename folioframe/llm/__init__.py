"""The subpackage of training-data operators; nothing else in the library imports it."""
