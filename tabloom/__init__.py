"""tabloom: table analytics operators written as Spark DataFrame transformations."""
