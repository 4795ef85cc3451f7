"""Tables, document files and prepared texts."""
