"""Tables, objects and files that operators read and write."""
