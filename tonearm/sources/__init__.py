"""Reading and writing: the extract lake, warehouse tables, source databases, change streams."""
