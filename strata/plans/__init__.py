"""Jobs and analytical plans composed from the operators."""
