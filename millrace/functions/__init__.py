"""Column functions; import the module you need."""
